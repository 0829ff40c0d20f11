import random
from collections import Counter

from lookback.llm.linedup import dedup_lines


def brute_longest(rows, least):
    """Deleted lines per row: the longest match of every place with any earlier place."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    lines = [[] if t is None else t.split("\n") for _, t in rows]
    places, gone = [], [set() for _ in rows]
    for i in order:
        own = lines[i]
        for s in range(len(own)):
            best = 0
            for j, t in places:
                n = 0
                while s + n < len(own) and t + n < len(lines[j]) and own[s + n] == lines[j][t + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.encode().split()) for x in own[s : s + best]) >= least:
                gone[i] |= set(range(s, s + best))
            places.append((i, s))
    return Counter(
        (d, None if t is None else "\n".join(x for n, x in enumerate(own) if n not in out), len(out))
        for (d, t), own, out in zip(rows, lines, gone, strict=True)
    )


def check_longest(spark, rows, least):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, line string").coalesce(1)
    got = dedup_lines(docs, min_words=least)
    assert got.columns[:4] == docs.columns
    assert Counter((r.doc_id, r.text, r.lb_deleted) for r in got.collect()) == brute_longest(rows, least)


def test_random_lines_equal_brute_force(spark):
    rng = random.Random(3)
    few = ["a b", "c", "d e f", "", "g h i", "x x x", "q", " "]
    rows = [
        (
            rng.choice([None, *range(40)]),
            None if rng.random() < 0.05 else "\n".join(rng.choice(few) for _ in range(rng.randint(1, 25))),
        )
        for _ in range(60)
    ]
    check_longest(spark, rows, 6)


def test_long_runs_and_copies(spark):
    body = [f"line {i} of the passage" for i in range(70)]
    rows = [(5, "\n".join(body)), (2, "\n".join(["own", *body, "tail"])), (9, "\n".join(body[10:60]))]
    rows += [(i, "\n".join(["head", *body[i : i + 3]])) for i in range(20, 30)]
    rows += [(50, "again\n" * 40), (51, "short"), (52, "short")]
    check_longest(spark, rows, 12)


def test_first_copy_and_short_repeats_stay(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = [(1, f"a\n{passage}\nb"), (2, f"c\n{passage}"), (3, "a\nb")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "c", 3: "a\nb"}


def test_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = dedup_lines(edge_docs, min_words=10)
    assert Counter((r.doc_id, r.text, r.lb_deleted) for r in got.collect()) == brute_longest(rows, 10)
    assert dedup_lines(no_docs).count() == 0


def test_longer_match_than_with_the_first_place_of_the_leading_lines(spark):
    a, b, c, x = (" ".join(f"{name}{i}" for i in range(20)) for name in "abcx")
    docs = [(1, "\n".join([a, b, x])), (2, "\n".join([a, b, c])), (3, "\n".join([a, b, c]))]
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.lb_deleted for r in got} == {1: 0, 2: 0, 3: 3}


def test_longest_match_with_any_earlier_place(spark):
    rng = random.Random(11)
    bodies = [[f"{b} {i} of it" for i in range(23)] for b in range(3)]
    for b in bodies:
        b[:5] = ["top", "of all", "pages here", "and", "so on"]
    rows = []
    for i in range(60):
        body = rng.choice(bodies)
        start = rng.randrange(0, 8)
        own = body[start : start + rng.randint(1, 16)]
        rows.append((rng.randrange(50), "\n".join([*own, *rng.choice(bodies)[: rng.randrange(9)], f"end {i % 7}"])))
    check_longest(spark, rows, 24)
    few = ["a b", "c", "d e f", "", "g h i"]
    check_longest(spark, [(i % 30, "\n".join(rng.choice(few) for _ in range(rng.randint(1, 20)))) for i in range(40)], 12)
