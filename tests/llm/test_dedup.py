"""Near-duplicate, line, substring and embedding dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import line_dedup as L
from strata.llm.components import components
from strata.llm.embed_dedup import embedding_classes
from strata.llm.jaccard_join import near_classes
from strata.llm.substring_dedup import FmIndex, substring_dedup
from strata.llm.wordhash import hash_spans, mix
from tests.llm import brute

DOC = "doc_id long, text string, N_Shingles string, spans int"


def corpus(seed, n=120):
    """Exact and near copies, shared passages, short, empty, null and long texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdEé") for _ in range(r.randint(1, 3)))
    text = lambda k: " ".join(word() for _ in range(k))
    passage, base, out = text(40), [text(r.randint(5, 90)) for _ in range(12)], []
    for i in range(n):
        w = r.choice(base).split(" ") if r.random() < 0.6 else text(r.randint(0, 60)).split(" ")
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            at = r.randrange(len(w) + 1)
            w[at:at] = passage.split(" ")[r.randint(0, 10):r.randint(25, 40)]
        out.append((i, r.choice([" ", "\n", "\t "]).join(w)))
    out += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "a"), (n + 4, "A"), (n + 5, " ".join([passage] * 300)), (n + 6, "x " * 500)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "other", 1) for i, t in rows], DOC).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes(spark, seed):
    rows = corpus(seed)
    got = near_classes(frame(spark, rows), k=4, percent=85)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == sorted(brute.near_classes(rows, 4, 85))


def test_near_classes_of_repeated_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(3, text), (3, text), (None, text), (2, "other words that stand here all alone"), (2, text.upper()), (None, None), (None, "lonely words")]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(3, 4, 2), (3, 4, 2), (None, 4, 2), (2, 4, 2), (2, 4, 2), (None, 0, None), (None, 1, None)], key=str)


def test_near_classes_of_a_chain(spark):
    """Neighbours link, ends do not: one class through links; and a class of many near copies around one text."""
    w = [f"w{i}" for i in range(60)]
    rows = [(100 + i, " ".join(w[i:i + 40])) for i in range(20)]
    rows += [(i, " ".join([*(f"v{j}" for j in range(50)), f"end{i}"])) for i in range(60)]
    assert sorted(map(tuple, near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == sorted(brute.near_classes(rows, 4, 85))


def test_near_classes_of_one_group_of_near_copies_meet_few_pairs(spark):
    """Texts of one size, most too far from each other to link: prefixes that share fewer tokens than their sizes ask for do not meet."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in r.sample(range(150), (0, 1, 2, 4, 5, 6)[i % 6]):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    from strata.llm import jaccard_join as J
    met, cross = [], J._cross
    J._cross = lambda *a, **b: (met.append(p := cross(*a, **b)), met.append(p.count()), p)[2]
    try:
        got = sorted(map(tuple, near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    finally:
        J._cross = cross
    assert got == sorted(brute.near_classes(rows, 4, 85))
    assert sum(met[1::2]) <= 5 * len(rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_need_holds_for_all_prefixes(percent):
    """Sets that link share that many tokens of their prefixes, and the need of a node is the least over the sizes it may meet."""
    from strata.llm.jaccard_join import prefix_length
    r = random.Random(percent)
    for _ in range(3000):
        n = r.randint(1, 160)
        m = r.randint(-(-percent * n // 100), n)
        both = r.randint(-(-percent * (n + m) // (100 + percent)), m) if -(-percent * (n + m) // (100 + percent)) <= m else None
        if both is None:
            continue
        order = r.sample(range(400), n + m - both)
        s, t = sorted(order[:n]), sorted(order[n - both:])
        need = -(-percent * (n + m) // (100 + percent)) - max(0, -(-percent * n // 100) - 8)
        assert len(set(s[:prefix_length(n, percent)]) & set(t[:prefix_length(m, percent)])) >= need


@pytest.mark.parametrize("percent", [80, 85])
def test_own_need_is_the_least_of_its_partners(spark, percent):
    from strata.llm.jaccard_join import _need, _own_need
    rows = [(n, lo, hi) for n in range(1, 90, 4) for lo in range(1, 100, 6) for hi in range(lo, 110, 7)]
    d = spark.createDataFrame(rows, "n long, lo long, hi long").withColumn("own", _own_need(percent))
    d = d.withColumn("m", F.explode(F.sequence("lo", "hi"))).where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    assert d.where(F.col("own") > _need(F.col("n"), F.col("m"), percent)).isEmpty()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 102), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    got = substring_dedup(frame(spark, rows), width=20).select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.repeated_words(rows, 20))


def test_substring_dedup_of_repeated_rows(spark):
    """Equal rows are one document; under one id the order of different texts is that of their hashes."""
    passage = " ".join(f"p{i}" for i in range(30))
    got = substring_dedup(spark.createDataFrame([(1, passage), (1, passage), (None, "x " + passage), (5, passage + " y")], "doc_id long, text string"))
    assert sorted((r["doc_id"] or -1, r["text"], r["n_removed"]) for r in got.collect()) == [(-1, "x " + passage, 0), (1, "", 30), (1, "", 30), (5, "y", 30)]


def test_fm_index_finds_exactly_the_repeated_windows():
    rng = np.random.default_rng(5)
    runs = [rng.integers(1, 4, rng.integers(15, 60)) for _ in range(12)]
    words = np.concatenate([runs[i][rng.integers(0, 5):] for i in rng.integers(0, 12, 150)])
    words[::97] = words[-1] = 0
    index = FmIndex(words, 5)
    window = np.array([i for i in range(len(words) - 19) if (words[i:i + 20] > 0).all()])
    hit, first = index.repeated(window)
    seen = {}
    for i in range(len(words) - 19):
        seen.setdefault(tuple(words[i:i + 20]), []).append(i)
    want = {i: seen[tuple(words[i:i + 20])][0] for i in window.tolist() if len(seen[tuple(words[i:i + 20])]) > 1}
    assert dict(zip(hit.tolist(), first.tolist(), strict=True)) == want and want


def is_cut(line, divisor=2):
    b = np.frombuffer(line.encode() + b"\n", np.uint8)
    return int(mix(hash_spans(b, np.array([0]), np.array([len(b) - 1])))[0]) % divisor == 0


def plain_chunks(lines):
    """(begin, end) of the chunks of one text's lines, one line after the other."""
    out, begin = [], 0
    for i, x in enumerate(lines):
        if i == len(lines) - 1:
            if i == begin and out:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((begin, i + 1))
        elif is_cut(x) and i > begin:
            out.append((begin, i + 1))
            begin = i + 1
    return out


def plain_line_dedup(rows):
    """Per id the text and the number of lines removed: repeated chunks, and what agrees around them with the first occurrence."""
    first, out = {}, {}
    for i, t in rows:
        lines = (t or "").split("\n")
        parts = plain_chunks(lines) if t else []
        keep = [True] * len(lines)
        for j, (a, b) in enumerate(parts):
            before, behind = lines[parts[j - 1][0]:a] if j else [], lines[b:parts[j + 1][1]] if j + 1 < len(parts) else []
            if b - a > 1 and any(x.strip(" \t\n\x0b\x0c\r") for x in lines[a:b]):
                place, head, tail = first.setdefault(tuple(lines[a:b]), ((i, a), before, behind))
                if place != (i, a):
                    while before and head and before[-1] == head[-1]:
                        a, before, head = a - 1, before[:-1], head[:-1]
                    while behind and tail and behind[0] == tail[0]:
                        b, behind, tail = b + 1, behind[1:], tail[1:]
                    keep[a:b] = [False] * (b - a)
        out[i] = (t if t is None else "\n".join(x for x, ok in zip(lines, keep, strict=True) if ok), keep.count(False))
    return out


def test_line_dedup(spark):
    r = random.Random(9)
    pool = [f"line {i}" for i in range(30)] + ["", "  "]
    block = [r.choice(pool) for _ in range(40)]
    rows = []
    for i in range(60):
        own = [r.choice(pool) + str(r.randint(0, 3)) for _ in range(r.randint(0, 20))]
        at = r.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + block[:r.randint(0, 40)] + own[at:])))
    rows += [(60, None), (61, ""), (62, "\n\n\n"), (63, "\n\n\n"), (64, "one line"), (65, "one line"), (66, "\n".join(["a", "b"] * 3000))]
    want = plain_line_dedup(rows)
    got = L.line_dedup(spark.createDataFrame([(*x, 7, 8) for x in rows], "doc_id long, text string, Lines_Removed int, chunk int").repartition(4))
    assert got.columns == ["doc_id", "text", "chunk", "lines_removed"]
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in got.collect()} == want
    assert sum(n for _, n in want.values()) > 500 and want[65] == ("one line", 0) and want[63] == ("\n\n\n", 0)


def test_line_chunks_resist_shifts():
    """After a few lines, a text with lines put in front is cut where it was cut before."""
    lines = [f"l{i}" for i in range(200)]
    a = {e for _, e in plain_chunks(lines)}
    b = {e - 3 for _, e in plain_chunks(["new", "and", "other", *lines])}
    assert len(a - b) <= 4 and len(a) > 30
    _, start, _, doc, begin, last, first = L.line_chunks(["\n".join(lines).encode(), b"", b"x", b"\n"], 1, 2)
    assert [(x, y + 1) for x, y in zip(begin[doc == 0].tolist(), last[doc == 0].tolist(), strict=True)] == plain_chunks(lines)
    assert first.tolist() == [0, 200, 201, 202, 204] and len(start) == 204


def earlier_runs(rows):
    """Per id the lines that stand in a run of two or more different dark lines which an earlier document holds; sorted ids, all texts different."""
    seen, out = set(), {}
    for i, t in rows:
        lines = t.split("\n")
        pairs = [(a, b) if a != b and a.strip() and b.strip() else None for a, b in zip(lines, lines[1:])]
        out[i] = {x for j, p in enumerate(pairs) if p in seen for x in (j, j + 1)}
        seen |= {p for p in pairs if p}
    return out


def test_line_dedup_removes_passages(spark):
    """Passages at any place of texts that share nothing else: whole or not at all, two thirds of those of five lines and more at least, and nothing else goes."""
    r, rows, own_of = random.Random(2), [], {}
    passages = [[f"passage {p} line {j}" for j in range(2 + p % 9)] for p in range(90)]
    for i in range(360):
        own = [f"own {i} {j}" for j in range(r.randint(2, 9))]
        at = r.randrange(1, len(own))
        rows.append((i, "\n".join([*own[:at], *passages[i % 90], *own[at:]])))
        own_of[i] = own
    rows += [(360, "\n".join(["lone", passages[3][0], "lines", passages[4][1], "stay"]))]
    got = {r["doc_id"]: r["text"] for r in L.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: t for i, (t, _) in plain_line_dedup(rows).items()} and got[360] == rows[360][1]
    gone = Counter()
    for i, t in rows[:360]:
        left = [x for x in got[i].split("\n") if not x.startswith("passage")]
        assert left == own_of[i] and (i >= 90 or got[i] == t)
        if i >= 90:
            kept = len(got[i].split("\n")) - len(left)
            gone[len(passages[i % 90]) >= 5, kept == 0] += 1
    assert gone[True, True] > 0.65 * (gone[True, True] + gone[True, False])


def test_line_dedup_share_on_the_table(spark):
    """The first occurrence of every line of sf0.01 stays; the share of the lines in earlier runs that goes is that of the README or more; the result is the plain one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    first = {}
    for i, t in reversed(rows):
        first.update(dict.fromkeys(t.split("\n"), i))
    found = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in L.line_dedup(docs).collect()}
    assert found == plain_line_dedup(rows)
    assert all(x in found[i][0].split("\n") for x, i in first.items())
    runs = sum(map(len, earlier_runs(rows).values()))
    assert sum(n for _, n in found.values()) > 0.5 * runs > 25


def test_embedding_classes(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 24))
    rows = []
    for i in range(150):
        x = base[rng.integers(12)] + rng.standard_normal(24) * rng.choice([0, 0.02, 0.1, 0.15, 1])
        rows.append((i, (x * rng.uniform(0.1, 9)).tolist(), int(rng.integers(3)) if i % 17 else None))
    rows += [(150, None, 1), (151, [0.0] * 24, 1), (152, [float("nan")] * 24, 1), (153, [None] + [1.0] * 23, 1), (154, [float("inf")] * 24, 1),
             (155, [], 1), (156, [1.0, 0.0], 1), (157, [2.0, 0.0], 1), (158, [1.0, -0.0], 1), (None, [3.0, 0.0], 1), (159, [1.0, 0.0], 2), (160, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, node string, KEPT string").repartition(3)
    got = embedding_classes(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = [(*r, r[0] == r[2]) for r in brute.embedding_classes(rows, 0.98)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 50


def test_embedding_classes_over_many_tiles(spark, monkeypatch):
    """With small tiles the result is the same."""
    import strata.llm.embed_dedup as E
    monkeypatch.setattr(E, "_TILE_BYTES", 2048)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + rng.standard_normal(16) * 0.05).tolist(), 1) for i in range(400)]
    got = embedding_classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    want = [(*r, r[0] == r[2]) for r in brute.embedding_classes([(i, np.float32(x).astype(float).tolist(), c) for i, x, c in rows], 0.98)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("run", [
    lambda s: near_classes(s.createDataFrame([], DOC)), lambda s: substring_dedup(s.createDataFrame([], DOC)), lambda s: L.line_dedup(s.createDataFrame([], DOC)),
    lambda s: embedding_classes(s.createDataFrame([], "vec_id long, embedding array<float>, label int"))])
def test_empty_tables(spark, run):
    assert run(spark).collect() == []
