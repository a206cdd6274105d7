"""Quality rules, importance resampling and the source audit against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import quality_rules as rules
from strata.llm import resampling, source_audit
from strata.llm.transducer import Transducer, build

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "one", "a b", "a b c", "a a a a", "a b c a b c", "the The THE \x0bthe", "x\x00y \x01 \x00", "é é é é 漢字 漢字 漢字", "- a\n* b\n• c\n- a\n", "so...\nmore… \nso...\n so...",
       "a\r\na\r\n", "|| || $$ %% 12 3.4", "w " * 30000, " ".join(f"w{i % 700}" for i in range(20000)), "🙂 🙂 🙂 🙂"]


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
    stop = {*rules.STOP_WORDS, *(s.capitalize() for s in rules.STOP_WORDS)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered), sum(x in stop for x in w),
            sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in x) for x in w), sum(x.lstrip(" \t\n\x0b\x0c\r")[0] in "-*•" for x in lines),
            sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines))


def test_quality_rules(spark):
    rng = np.random.default_rng(5)
    texts = ODD + [" ".join(rng.choice(["a", "b", "the", "B", "c\n", "$", "-x", "1...\n", "é"], rng.integers(1, 120))) for _ in range(150)]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, "null id", "x", 7), (3, texts[3], "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string, Kept int").repartition(4)
    got = rules.quality_rules(df)
    assert got.columns == ["doc_id", "text", "other", *rules.COUNTS, "base_failed", "rules_failed", "kept"] and got.count() == len(rows)
    assert "Python" not in got._jdf.queryExecution().toString()
    for r in got.collect():
        c = counts(r["text"])
        assert tuple(r[k] for k in rules.COUNTS) == c
        v = dict(zip(rules.COUNTS, c, strict=True))
        failed = c[0] < 50 or 100 * v["n_repeat_words"] > 50 * c[0]
        broken = [x.name for x in rules.RULES if v[x.whole] and (x.least is not None and 100 * v[x.part] < x.least * v[x.whole] or x.most is not None and 100 * v[x.part] > x.most * v[x.whole])]
        assert (r["base_failed"], r["rules_failed"], r["kept"]) == (failed, broken, not failed and not broken)
    assert rules.quality_rules(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule, text, broken", [(rules.Rule("most", "n_symbols", "n_words", most=50), "a | b |", False), (rules.Rule("most", "n_symbols", "n_words", most=49), "a | b |", True),
                                                (rules.Rule("least", "n_stop_words", "n_words", least=50), "the x", False), (rules.Rule("least", "n_stop_words", "n_words", least=51), "the x", True),
                                                (rules.Rule("none", "n_dup_lines", "n_lines", least=1, most=1), " ", False)])
def test_rules_hold_at_their_bounds(spark, rule, text, broken):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = rules.quality_rules(df, rules=(rule,), base=(0, 100)).first()
    assert (r["rules_failed"] == [rule.name]) == broken and r["kept"] == (not broken)
    assert rules.quality_rules(df, rules=(), base=(0, 100)).first()["kept"]


FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_n):
    w = FEATURE_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, max_n, buckets, percent, min_words, seed):
    """Sorted (id, n_features, weight, score), and the ids in the order drawn."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x, max_n)[1]) for texts in ([x for _, x in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    out, order = [], []
    for i, x in rows:
        n, f = features(x, max_n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score))
        if n >= min_words:
            order.append((-score, i is not None, i or 0))
    return sorted(out, key=str), [(i if some else None) for _, some, i in sorted(order)[:len(order) * percent // 100]]


@pytest.mark.parametrize("max_n, percent, min_words, buckets", [(1, 10, 20, 10_000), (2, 50, 3, 64), (3, 100, 0, 1000), (1, 0, 1, 10)])
def test_resample(spark, max_n, percent, min_words, buckets):
    rng = np.random.default_rng(max_n)
    words = ["a", "B", "the", "42", "é", "漢字", "x-y", "\x01z"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(300)] + list(enumerate(ODD, 1000)) + [(None, "null id " * 9), (-5, "a b c"), (7, None)]
    target = [" ".join(rng.choice(words[:4], 30)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, weight string, Rank int").repartition(5)
    how = {"percent": percent, "min_words": min_words, "max_n": max_n, "buckets": buckets, "seed": "s"}
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, bench, **how)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = got.collect()
    want, order = plain_resample(rows, target, max_n, buckets, percent, min_words, "s")
    assert sorted((tuple(r)[:4] for r in got), key=str) == want
    ranked = sorted((r["rank"], r["doc_id"]) for r in got if r["rank"] is not None) if percent else []
    assert [r for r, _ in ranked] == list(range(1, len(order) + 1)) and [i for _, i in ranked] == order
    if percent == 50:
        kept = resampling.drawn(df, bench, **how)
        assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(order, key=str)
    assert resampling.resample(df.limit(0), bench, **how).count() == 0


def test_resample_of_repeated_rows(spark):
    """A third of the rows are one row; ranks stay whole numbers without a gap."""
    rows = [(1, "same words here " * 10)] * 100 + [(i, f"other words {i} " * 10) for i in range(2, 202)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bench = ["same here " * 500] * 4
    order = plain_resample(rows, bench, 1, 10_000, 20, 20, "2024")[1]
    assert order == [1] * 60        # there is room for some of the equal rows only
    got = resampling.resample(df, spark.createDataFrame([(t,) for t in bench], "text string"), percent=20, min_words=20)
    assert got.count() == 300 and sorted((r["rank"], r["doc_id"]) for r in got.where("rank is not null").collect()) == list(enumerate(order, 1))


@pytest.mark.parametrize("pivots", [1, 3, 24])
def test_kth_key(spark, monkeypatch, pivots):
    monkeypatch.setattr(resampling, "_PIVOTS", pivots)
    keys = [(d, n, i, 0) for d in (-5, 0, 3) for n in (0, 1) for i in (1, 2, 2, 9)]
    df = spark.createDataFrame(keys, "down long, no_id int, id long, h long").coalesce(1)
    for k in (1, 7, 8, 24):
        assert resampling.kth_key(df, k) == sorted(keys)[k - 1]


def test_transducer():
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcé漢\0"), rng.integers(0, 8))).encode() for _ in range(4000)})
    machine = Transducer.unpacked(build(words).packed())
    asked = words + [b"zz", b"a" * 40, b"abcabcabcabc"]
    buf, n = np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked])
    want = [words.index(w) if w in set(words) else -1 for w in asked]
    assert machine.walk(buf, np.cumsum(n) - n, n).tolist() == want
    assert machine.after(b"zz") is None and machine.after(b"") == (machine.start, 0)
    tails = [b"ing", b"ed", b"s", b""]
    small = build(sorted(a + b for a in (b"walk", b"talk", b"jump") for b in tails))
    held = [a + b for a in (b"walk", b"talk", b"jump") for b in tails]
    assert len(small.final) == len({frozenset(w[i:] for w in held if w.startswith(p[:i])) for p in held for i in range(len(p) + 1)})      # one state for each set of tails
    assert build([]).walk(buf, np.cumsum(n) - n, n).max() == -1


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, min_docs, top):
    rows = [(x or "", s or "", TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))) for x, s, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs = Counter(t for r in own for t in set(r[2]))
        kept = [t for t, n in docs.items() if n >= min_docs]
        groups = {s: Counter(t for r in own if r[1] == s for t in r[2] if t in set(kept)) for s in {r[1] for r in own}}
        whole = sum(groups.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        for s, c in groups.items():
            p = {t: share(c, t) for t in kept}
            pairs = [(-sum((p[t] - share(d, t)) ** 2 // (p[t] + share(d, t)) for t in kept), o.encode()) for o, d in groups.items() if o != s]
            terms = [(-((p[t] - share(whole, t)) ** 2 // (p[t] + share(whole, t))), t.encode()) for t in kept if c[t] and p[t] > share(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, part_terms, block", [(3, 7, 5), (2, 16_384, 1024), (1, 3, 2), (1000, 10, 10)])
def test_source_divergence(spark, monkeypatch, min_docs, part_terms, block):
    monkeypatch.setattr(source_audit, "_BLOCK", block)
    rng = np.random.default_rng(min_docs)
    words = ["the", "The", "a", "b", "é", "É", "zürich", "漢字", "ab", "abc", "x1y", "tail", "tails", "2024", "o'clock", "🙂", "qq"] + [f"w{a}{b}" for a in "abcdefg" for b in "xyz"]
    rows = [(str(rng.choice(["en", "e", "de", ""])), str(rng.choice(["s", "t", "é", "src1", ""])), " ".join(rng.choice(words, rng.integers(0, 30)))) for _ in range(150)]
    rows += [(None, None, "a b c"), ("en", None, None), (None, "s", "the the"), ("xx", "only", "a"), ("en", "lonely", ""), ("yy", "p", None), ("yy", "q", ""), ("de", "t", "long " * 20000), ("en", "s", "a " * 3)] * 2
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, Part string").repartition(5)
    got = source_audit.source_divergence(df, min_docs=min_docs, top=4, part_terms=part_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, min_docs, 4)
    assert source_audit.source_divergence(df.limit(0), min_docs=min_docs).count() == 0


def test_shares_are_exact():
    count, whole = np.array([0, 1, 17, 9 * 10**15 - 10], np.int64), 9 * 10**15
    assert source_audit.shares(count, whole).tolist() == [1 + 10**9 * (c + 2) // whole for c in count.tolist()]
