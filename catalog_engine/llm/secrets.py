"""Secrets in texts: strong patterns, and weak ones that are linked.

Strong spans are found alone: assignments of six characters or more to a secret
name, access identifiers, long hexadecimal strings. Weak candidates (a user
name, an endpoint, an opaque string, an assignment to a vague name) say nothing
alone; they are reported only where complementary parts of one credential
co-occur. Each part has roles: identifier (access, user), secret (assign, hex,
opaque, phrase) or endpoint.

Scopes: a text falls into blocks at blank lines; parts meet their block by an
interval join (both dealt by text and by stretches of BUCKET code points, so no
long text is one key). Inside a block, scopes are windows of 2 * REACH code points,
a new one every REACH, so any two parts that start within REACH of each other
share one. Per scope only four counts are kept: no pairs are built. Reported are

* a user name, where its scope holds a secret part;
* an opaque string or phrase, where its scope holds an identifier;
* an endpoint, where its scope holds a strong secret, or an identifier and any
  secret part.

Everything is DataFrame functions and joins. A text is read once: what leaves
the scan are the lengths of the matches and of the gaps between them (written to
the shared folder), and positions are running sums of those.

Defined cases: a null or empty text has no spans; rows are told apart by number,
so repeated rows, null ids and ties keep a row each; other columns play no part;
positions are code points, end exclusive. Weak parts that overlap a strong span
are dropped, and a weak part that overlaps a weak part of an earlier kind too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Code points between the starts of two parts that always share a scope.
REACH = 200
#: Code points of a stretch in the interval join.
BUCKET = 4096
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_OPAQUE = 6, 20, 24, 20


def _any_case(name: str) -> str:
    """A pattern for a name in either case of ASCII letters, whatever the engine folds."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({'|'.join(map(_any_case, ['password', 'passwd', 'secret', 'token', 'api_?key']))}){_GIVEN}([A-Za-z0-9+/_.=-]+)"
USER = f"({'|'.join(map(_any_case, ['username', 'user', 'login', 'account', 'client_?id']))}){_GIVEN}([A-Za-z0-9_.@+-]+)"
PHRASE = f"({'|'.join(map(_any_case, ['passphrase', 'pass', 'pwd', 'pin', 'private_?key', 'credential']))}){_GIVEN}([^\\x20\\x09-\\x0D\"',;]+)"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+"""
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
BLANK_LINES = r"\n[\x20\t\r]*(?:\n[\x20\t\r]*)+"

#: kind: (pattern, group whose length counts, least length, a text without these holds none).
KINDS = {
    "assign": (ASSIGN, 2, MIN_ASSIGNED, ("=", ":")),
    # a run of the characters is one match, long or short, so the length may stand in the pattern
    "access": (f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}", 0, MIN_ACCESS, ("AKIA",)),
    "hex": (f"[0-9a-f]{{{MIN_HEX},}}", 0, MIN_HEX, ()),
    "user": (USER, 2, 2, ("=", ":")),
    "endpoint": (ENDPOINT, 0, 0, ("://",)),
    "opaque": (OPAQUE, 0, MIN_OPAQUE, ()),
    "phrase": (PHRASE, 2, 3, ("=", ":")),
}
ORDER = list(KINDS)
STRONG = ORDER[:3]
IDENTIFIERS, SECRETS = ["access", "user"], ["assign", "hex", "opaque", "phrase"]


def _gaps(text: Column, pattern: str) -> Column:
    """Lengths of what lies between the matches, and after the last."""
    return F.transform(F.split(text, pattern, -1), F.length)


def _hits(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _matches(kind: str, text: Column) -> Column:
    """struct(gaps, sizes, good) of one kind, null where there is no match."""
    pattern, group, least, needs = KINDS[kind]
    some = text.rlike(pattern)
    if needs:
        held = text.contains(needs[0])
        for x in needs[1:]:
            held = held | text.contains(x)
        some = held & some
    if kind == "opaque":  # capitals, small letters and digits
        good = F.transform(_hits(text, pattern), lambda x: x.rlike("[A-Z]") & x.rlike("[a-z]") & x.rlike("[0-9]"))
    else:
        good = F.transform(_hits(text, pattern, group), lambda x: F.length(x) >= least)
    found = F.struct(_gaps(text, pattern).alias("gaps"), F.transform(_hits(text, pattern), F.length).alias("sizes"),
                     good.alias("good"))
    return F.when(some, found)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id and the matches of every kind; block lengths where a weak kind matched."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       *[_matches(k, text).alias(k) for k in ORDER], text.alias("text"))
    weak = F.lit(False)
    for k in ORDER[3:]:
        weak = weak | F.coalesce(F.exists(F.col(f"{k}.good"), lambda x: x), F.lit(False))
    blocks = F.when(weak, F.struct(_gaps(F.col("text"), BLANK_LINES).alias("gaps"),
                                   F.transform(_hits(F.col("text"), BLANK_LINES), F.length).alias("sizes")))
    # written, so that the row numbers hold and no text is read again
    return cut(rows.select("row", "doc_id", *ORDER, blocks.alias("blocks")))


def _placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """start and end of every match from rows of (keys, pos, gap, size): running sums."""
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.sum(F.col("gap") + F.col("size")).over(before), F.lit(0))
    return rows.withColumn("start", (done + F.col("gap")).cast("long")).withColumn("end", F.col("start") + F.col("size"))


def parts(scanned: DataFrame) -> DataFrame:
    """(row, number of the kind, kind, start, end) of all matches that are long enough."""
    each = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(k).alias("kind"), F.col(k).alias("m"))
                     for i, k in enumerate(ORDER)])
    rows = (scanned.select("row", F.explode(F.filter(each, lambda x: x["m"].isNotNull())).alias("x"))
            .select("row", "x.number", "x.kind", F.posexplode(F.arrays_zip("x.m.gaps", "x.m.sizes", "x.m.good")).alias("pos", "z"))
            .select("row", "number", "kind", "pos", F.col("z.gaps").alias("gap"), F.col("z.sizes").alias("size"), F.col("z.good").alias("good"))
            .filter("size is not null"))
    return _placed(rows, ["row", "number"]).filter("good").select("row", "number", "kind", "start", "end")


def _apart(found: DataFrame) -> DataFrame:
    """Parts without weak ones that overlap a strong span, or a weak one of an
    earlier kind. Spans of one kind do not overlap, so the farthest end before a
    part and the nearest start after it tell."""
    out = found
    for number, kind in list(enumerate(ORDER))[len(STRONG):]:
        rival = F.col("number") < number
        by = Window.partitionBy("row").orderBy("start", "number")
        ends = F.max(F.when(rival, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
        starts = F.min(F.when(rival, F.col("start"))).over(by.rowsBetween(1, Window.unboundedFollowing))
        out = out.withColumn("_lo", ends).withColumn("_hi", starts).filter(
            (F.col("number") != number) | (F.coalesce(F.col("_lo") <= F.col("start"), F.lit(True))
                                           & F.coalesce(F.col("_hi") >= F.col("end"), F.lit(True)))).drop("_lo", "_hi")
    return out


def linked(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, number, kind, start, end) of the weak parts whose complement is in a scope with them."""
    texts = scanned.filter("blocks is not null")
    blocks = _placed(texts.select("row", F.posexplode(F.arrays_zip("blocks.gaps", "blocks.sizes")).alias("pos", "z"))
                     .select("row", "pos", F.col("z.gaps").alias("gap"), F.coalesce("z.sizes", F.lit(0)).alias("size")), ["row"])
    # a block is what lies before the blank lines
    blocks = blocks.select("row", F.col("pos").alias("block"), (F.col("start") - F.col("gap")).alias("lo"), F.col("start").alias("hi")
                           ).filter("hi > lo")
    # every stretch of a text that a block reaches into
    blocks = blocks.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("lo") / BUCKET), F.floor((F.col("hi") - 1) / BUCKET))))
    own = _apart(parts(texts)).withColumn("stretch", F.floor(F.col("start") / BUCKET))
    inside = own.join(blocks, ["row", "stretch"]).filter("lo <= start AND start < hi")
    scope = F.floor((F.col("start") - F.col("lo")) / reach)
    inside = inside.withColumn("scope", F.explode(F.array(scope - 1, scope))).select(
        "row", "block", "scope", "number", "kind", "start", "end")
    is_in = lambda kinds: F.max(F.col("kind").isin(kinds))
    held = inside.groupBy("row", "block", "scope").agg(
        is_in(IDENTIFIERS).alias("identifier"), is_in(SECRETS).alias("secret"),
        is_in([k for k in STRONG if k in SECRETS]).alias("strong"))
    weak = inside.filter(~F.col("kind").isin(STRONG)).join(held, ["row", "block", "scope"])
    told = (F.when(F.col("kind") == "user", F.col("secret"))
            .when(F.col("kind") == "endpoint", F.col("strong") | (F.col("identifier") & F.col("secret")))
            .otherwise(F.col("identifier")))
    return weak.filter(told).select("row", "number", "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id and spans, an array of (start, number of the
    kind, kind, end) in that order: all strong spans and the linked weak ones."""
    scanned = scan(docs, id_col, text_col)
    strong = parts(scanned).filter(F.col("kind").isin(STRONG))
    spans = strong.unionByName(linked(scanned, reach)).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "number", "kind", "end"))).alias("spans"))
    return scanned.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,number:int,kind:string,end:bigint>>")).alias("spans"))
