import base64
import gzip
import hashlib
import random

from catalog_engine.llm import warc as W


def plain(n, seed=0):
    r = random.Random(seed)
    return [W.record(k, f"http://x/{k}", ("é" * r.randint(0, 40) + f" WARC/1.1\r\n{k}").encode(), None, False) for k in range(n)]


def ids(data):
    return [W._page(r.headers["warc-record-id"]) for _, _, _, records in W.salvage(data) for r in records]


def problems(data):
    return [(a, b) for a, b, problem, _ in W.salvage(data) if problem]


def test_round_trip_of_both_kinds():
    for rows in (plain(9), [W.member(x) for x in plain(9)], [W.member(plain(9)[0]), *plain(9)[1:]]):
        data = b"".join(rows)
        assert ids(data) == list(range(9)) and problems(data) == []
        assert [(a, b) for a, b, *_ in W.salvage(data)][-1][1] == len(data)
    assert ids(b"") == [] and problems(b"") == []


def test_damage_costs_only_the_records_it_touches():
    for seed in range(120):
        r = random.Random(seed)
        rows = plain(12, seed) if seed % 2 else [W.member(x) for x in plain(12, seed)]
        ends = [sum(map(len, rows[:k + 1])) for k in range(12)]
        data, at = bytearray(b"".join(rows)), None
        hit = r.randrange(len(data))
        if seed % 2:  # headers of plain records have no check sum of their own
            k = r.randrange(12)
            hit = ends[k] - r.randint(1, len(rows[k]) - rows[k].index(b"\r\n\r\n") - 4)
        how = r.randrange(4)
        if how == 0:
            data[hit] ^= 1 << r.randrange(8)
            lost = {next(k for k, e in enumerate(ends) if hit < e)}
        elif how == 1:
            del data[hit:hit + r.randint(1, 300)]
            lost = None
        elif how == 2:
            data[hit:hit] = bytes(r.randrange(256) for _ in range(50))
            lost = {next(k for k, e in enumerate(ends) if hit < e)}
        else:
            del data[hit:]
            lost = {k for k, e in enumerate(ends) if e > hit}
        found, bad = ids(bytes(data)), problems(bytes(data))
        assert found == sorted(set(found)) and set(found) <= set(range(12))
        if lost is not None:
            assert set(range(12)) - set(found) <= lost, (seed, how)
        covered = [(a, b) for a, b, *_ in W.salvage(bytes(data))]
        assert all(x[1] == y[0] for x, y in zip(covered, covered[1:])) and (not covered or covered[-1][1] == len(data))
        if len(found) < 12 and how < 3:
            assert bad


def test_records_of_a_damaged_member_are_recovered():
    rows = plain(10)
    whole, ends = b"".join(rows), [sum(map(len, rows[:k + 1])) for k in range(10)]
    # stored blocks: one damaged byte damages one byte of the plain data, and the check sum
    bad = bytearray(W.member(whole, 0))
    bad[bad.index(rows[4]) + len(rows[4]) - 6] ^= 1
    assert ids(bytes(bad)) == [0, 1, 2, 3, 5, 6, 7, 8, 9]
    (s,) = W.stretches(bytes(bad))
    assert (s.start, s.end, s.problem) == (0, len(bad), "gzip member is broken")
    assert (ends[3], ends[4], "block digest differs") in s.gaps
    # a sound member around damaged records
    wrong = whole[:ends[4] - 6] + b"?" + whole[ends[4] - 5:]
    (s,) = W.stretches(W.member(wrong))
    assert len(s.records) == 9 and s.problem is None and s.gaps == [(ends[3], ends[4], "block digest differs")]
    # cut off anywhere: the records that are whole before the cut stay
    noise = random.Random(1)
    loud = [W.record(k, None, noise.randbytes(3000).hex().encode(), None, False) for k in range(10)]
    packed = W.member(b"".join(loud))
    for cut in range(20, len(packed), 997):
        plain_bytes = zlib_prefix(packed[:cut])
        sure = sum(len(plain_bytes) >= sum(map(len, loud[:k + 1])) for k in range(10))
        assert ids(packed[:cut]) == list(range(sure))
        # the members behind it are not lost, nor read twice
        more = packed[:cut] + W.member(W.record(77, None, b"x", None, False)) + rows[8]
        assert ids(more) == [*range(sure), 77, 8]
        covered = list(W.stretches(more))
        assert covered[0].start == 0 and covered[-1].end == len(more)
        assert all(x.end == y.start for x, y in zip(covered, covered[1:]))


def zlib_prefix(data):
    import zlib
    unpack, out = zlib.decompressobj(31), b""
    for b in data:
        out += unpack.decompress(bytes([b]))
    return out


def test_damage_in_deflated_members_costs_no_later_member():
    for seed in range(60):
        r = random.Random(seed)
        groups = [plain(4, seed), plain(4, seed + 1), plain(4, seed + 2)]
        parts = [W.member(b"".join(g)) for g in groups]
        bad = bytearray(parts[1])
        bad[r.randrange(len(bad))] ^= 1 << r.randrange(8)
        found = ids(parts[0] + bytes(bad) + parts[2])
        assert found[:4] == found[-4:] == [0, 1, 2, 3] and set(found[4:-4]) <= {0, 1, 2, 3}
        assert len(found[4:-4]) == len(set(found[4:-4]))


def test_a_broken_member_needs_digests():
    rows = [b"\r\n".join(h for h in x.split(b"\r\n") if not h.startswith(b"WARC-Block-Digest")) for x in plain(3)]
    assert ids(b"".join(rows)) == [0, 1, 2]
    packed = W.member(b"".join(rows))
    assert ids(packed[:-8] + b"\0" * 8) == [] and problems(packed[:-8] + b"\0" * 8)
    assert ids(packed[:-8]) == [0, 1, 2]


def test_many_version_lines_without_header_end_are_linear():
    import time
    t = time.time()
    assert ids(W.VERSION * 300_000) == []
    assert time.time() - t < 20


def test_files_are_bounded_by_bytes(spark, tmp):
    import glob
    import os
    r = random.Random(3)
    rows = [(k, "u", r.randbytes(2000).hex()) for k in range(200)]
    W.write_archives(pages(spark, rows, 1), f"{tmp}/bytes", bytes_per_file=64 << 10)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp}/bytes/*.txt")]
    one = max(len(W.member(W.record(k, "u", h.encode(), None, False))) for k, _, h in rows) + len(W.EMPTY_MEMBER)
    assert len(sizes) > 4 and max(sizes) <= (64 << 10) + W.PIECES * one
    assert W.read_archives(spark, f"{tmp}/bytes").filter("problem is null").count() == 200


def test_inner_gaps_are_logged_by_the_reader(spark, tmp):
    import os
    rows = plain(5)
    ends = [sum(map(len, rows[:k + 1])) for k in range(5)]
    os.makedirs(f"{tmp}/inner")
    with open(f"{tmp}/inner/x.warc.gz", "wb") as f:
        f.write(W.member(rows[0] + b"junk" + b"".join(rows[1:])))
    read = W.read_archives(spark, f"{tmp}/inner")
    assert sorted(x.page_id for x in read.filter("problem is null").collect()) == [0, 1, 2, 3, 4]
    assert [(g.start, g.inner_start, g.inner_end) for g in W.gaps(read).collect()] == [(0, ends[0], ends[0] + 4)]


def pages(spark, rows, parts=4):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS text", "1 AS revisit").repartition(parts)


def brute(rows):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, u, h in rows:
        raw, t = (h or "").encode(), top.get(h or "")
        again = t is not None and i != t
        out.append((i, u, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", t if again else None))
    return sorted(out, key=repr)


def test_archives_read_back(spark, tmp):
    r = random.Random(1)
    bodies = ["", None, "é\r\n\r\nx", "a" * 70000] + [f"<p>{k}</p>\r\nWARC/1.0\r\n" for k in range(30)]
    rows = [(k, None if k % 17 == 0 else f"http://é/{k}", r.choice(bodies)) for k in range(300)]
    rows += [(k, "u", "hot") for k in range(400, 700)] + [(None, "n", "hot"), (None, None, "alone"), (-5, "m", "minus")]
    path = f"{tmp}/a"
    W.write_archives(pages(spark, rows), path, records_per_file=50)
    read = W.read_archives(spark, path)
    assert W.gaps(read).count() == 0
    got = [(x.page_id, x.url, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in read.collect()]
    assert sorted(got, key=repr) == brute(rows)
    payloads = {x.page_id: x.payload for x in read.filter("record_type = 'response'").collect()}
    assert all((payloads[i] or b"").decode() == (h or "") for i, _, h in rows if i is not None and i in payloads)
    # a file is a row of gzip members
    name = read.select("path").first()[0].replace("file:", "")
    with open(name, "rb") as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_gap_is_logged_by_the_reader(spark, tmp):
    import os
    rows = plain(5)
    os.makedirs(f"{tmp}/b")
    with open(f"{tmp}/b/x.warc", "wb") as f:
        f.write(rows[0] + rows[1][:30] + rows[2] + b"junk" + W.member(rows[3]) + rows[4])
    read = W.read_archives(spark, f"{tmp}/b")
    assert sorted(x.page_id for x in read.filter("problem is null").collect()) == [0, 2, 3, 4]
    found = sorted((g.start, g.end) for g in W.gaps(read).collect())
    a = len(rows[0])
    assert found == [(a, a + 30), (a + 30 + len(rows[2]), a + 34 + len(rows[2]))]


def test_empty_table(spark, tmp):
    W.write_archives(pages(spark, [], 1), f"{tmp}/c")
    assert W.read_archives(spark, f"{tmp}/c").count() == 0
