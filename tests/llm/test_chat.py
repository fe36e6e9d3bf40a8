import itertools
import random

from catalog_engine.llm import chat as C


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return (not roles) or (bool(body) and len(body) % 2 == 0
                           and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(body)))


def cheapest(given):
    """Least cost by trying every labelling, merging and number of empty turns."""
    best = None
    for labels in itertools.product((1, 2, 3), repeat=len(given)):
        for merged in itertools.product((False, True), repeat=len(given)):
            if any(m and (k == 0 or labels[k] != labels[k - 1]) for k, m in enumerate(merged)):
                continue
            cost = sum(C.RELABEL for a, b in zip(labels, given) if a != b) + C.MERGE * sum(merged)
            turns = [r for r, m in zip(labels, merged) if not m]
            if 1 in turns[1:]:
                continue
            # a lone sequence of system?, user, assistant, ...: fill by hand
            need, want = 0, 2
            for k, r in enumerate(turns):
                if k == 0 and r == 1:
                    continue
                if r != want:
                    need += 1
                want = 3 if r == 2 else 2
            if turns:
                need += 1 if want == 3 else 0
                need += 2 if turns == [1] else 0
            cost += C.INSERT * need
            best = cost if best is None else min(best, cost)
    return best or 0


def parse(rendered):
    out = []
    for piece in rendered.split(C.FOOTER)[:-1]:
        head, text = piece.split("|>\n", 1)
        out.append((head[2:], text))
    return out


def test_least_cost_by_enumeration():
    for n in range(5):
        for given in itertools.product(range(4), repeat=n):
            cost, roles, actions, text = C.render(["t"] * n, list(given), 0, None, True)
            assert cost == cheapest(given), given
            assert legal([r for r, _ in parse(text)]), (given, text)


def turns(spark, rows, parts=3):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS seg", "2 AS part", "3 AS cost").repartition(parts)


def random_rows(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 12)):
            rows.append((c, t, r.choice(["user", "assistant"] * 4 + ["system", "tool", None]), f"c{c}t{t}<|end|>"))
    return rows


def test_segments_give_the_same_repair(spark):
    rows = random_rows(1, 40) + [(99, t, random.Random(t).choice(["user", "assistant", "system"]), f"h{t}") for t in range(500)]
    whole = {}
    for r in C.format_chats(turns(spark, rows), segment=1000).collect():
        whole[r.conv_id] = whole.get(r.conv_id, 0) + r.cost
    small = {}
    for r in sorted(C.format_chats(turns(spark, rows, 7), segment=3).collect(), key=lambda r: (r.conv_id, r.part)):
        small.setdefault(r.conv_id, []).append(r)
    for c, parts in small.items():
        given = C.role_numbers([x[2] for x in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])])
        text = "".join(p.rendered for p in parts)
        assert [p.part for p in parts] == list(range(len(parts)))
        assert sum(p.cost for p in parts) == C.render(["x"] * len(given), given, 0, None, True)[0]
        assert legal([r for r, _ in parse(text)])
        assert sum(p.cost for p in parts) == whole[c]
        body = text
        for x in sorted((r for r in rows if r[0] == c), key=lambda r: r[1]):
            assert x[3].replace("<|", "< |") in body
            body = body[body.index(x[3].replace("<|", "< |")):]


def test_defined_cases(spark):
    rows = [(1, None, "assistant", "b"), (1, 0, "user", "a"), (None, 0, "user", None), (2, 0, "system", "s"),
            (3, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, None, "q"), (4, 1, "assistant", "r")]
    out = {r.conv_id: r for r in C.format_chats(turns(spark, rows)).collect()}
    assert out[1].rendered == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n" and out[1].cost == 0
    assert out[None].rendered == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert out[3].rendered == "<|user|>\nx\n\nx<|end|>\n<|assistant|>\n<|end|>\n"
    assert out[4].roles == ["user", "assistant"] and out[4].actions == ["relabel", "keep"]
    assert legal([r for r, _ in parse(out[2].rendered)])
    assert C.format_chats(turns(spark, [], 1)).count() == 0
