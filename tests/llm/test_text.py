"""URL filters, chat formatting, quality, packing, pieces and nearest neighbours."""

import math
import os
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import catalog
from strata.llm.ann_forest import Forest, nearest
from strata.llm.chat_format import escape, format_chat, unescape
from strata.llm.packing import best_cuts, pack
from strata.llm.quality import _AGAIN, _MUL, Features, fit_quality, hashed_features, quality_score, with_quality
from strata.llm.sentencepiece_ops import PieceModel, decode_pieces, with_pieces
from strata.llm.url_filter import url_filter
from strata.llm.wordhash import _BASE, _BYTE
from tests.llm import brute

ODD = ["", " ", "a", "İstanbul Σίσυφος ΟΔΟΣ", "e\u0301te\u0301 <|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", "it's we'll 'S 'tis. a.b,c!! ...", "\x1c\x1d a\x1fb\u2003c\x85d\u3000e",
       "漢字 テスト 123 ½ ²x", "  double   spaces\n\n tabs\t\t▁ ▁▁ x▁y  ", "🙂🙂🙂 ok", "a" * 3000, "ab " * 5000, "\x00\x01 \ufffd", "########   ====", "Word. word, WORD; don't-stop"]

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("/ads", "block"), ("a.b", "block"), ("A.b", "allow"),
         ("org/f", "block"), ("net/", "block"), (None, "block"), ("x.y/q", None), ("c+d.net/", "allow"), ("ample.net/en/", "block")]
URLS = [None, "", "no url", "http://Example.NET/en/1", "https://x.example.net/en/2?a=/de/", "http://badexample.net/en/3", "http://net/", "http://net", "net/", "http://a.org/fr/x", "http://a.org/fr",
        "http://a.org/f", "http://example.com/de/#x", "http://example.com?/de/", "http://a.b", "http://z.a.b?x", "http://ab", "http://c+d.net/1", "http://ccd.net/1", "ftp://q/ads.html", "x://", "://net/",
        "http://É.net/Ä", "http://example.net/en/" + "long/" * 5000, "a://b://net/", "http://x.org/fr/\nline"]


@pytest.mark.parametrize("rules", [RULES[:4], RULES, []])
def test_url_filter(spark, rules):
    rows = [(i, u, "p", "h") for i, u in enumerate(URLS + URLS)] + [(None, URLS[3], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Path string, token string")
    got = url_filter(pages, spark.createDataFrame(rules, "rule string, action string"))
    assert got.columns == ["page_id", "url", "token", "host", "path", "rule", "verdict"]
    want = [(i, u, t, *brute.url_verdict(u, rules)) for i, u, _, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert url_filter(pages.limit(0), spark.createDataFrame(rules, "rule string, action string")).count() == 0


CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "[\\INST]", "[\\\\INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "<s", "s>", "[", "<", "\\", "\n", "$1", "plain", "", "é🙂"]


def test_chat_round_trip(spark):
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool", "", None, "[ROLE]", "x[TEXT]", "assistant</s>"]
    rows = []
    for c in range(60):
        for t in range(rng.integers(1, 7)):
            text = "".join(rng.choice(CONTROL, rng.integers(0, 6)))
            rows.append((c, t, str(rng.choice(roles[:5])) if rng.random() < 0.8 else roles[rng.integers(9)], text if rng.random() < 0.9 else None))
    rows += [(99, 0, "user", "twice"), (99, 0, "user", "twice"), (99, None, "assistant", "[INST]" * 20000), (None, 1, "user", "no id"), (None, 2, "assistant", "none")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string").repartition(4)
    got = {r["conv_id"]: r for r in format_chat(df).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        g, turns = got[c], sorted(turns)
        assert g["round_trip"] and [tuple(t) for t in g["turns"]] == [t[2:] for t in turns]
        spans = [g["formatted"][s["start"]:s["start"] + s["length"]] for s in g["loss_spans"]]
        plain = [r[0] for r in spark.createDataFrame([(i, s) for i, s in enumerate(spans)], "i int, s string").orderBy("i").select(unescape(F.col("s"))).collect()]
        assert plain == [t[3] for t in turns if t[2] == "assistant"]
    assert format_chat(df.limit(0)).count() == 0


def test_escape_is_reversible(spark):
    texts = ["".join(p) for p in np.random.default_rng(1).choice(CONTROL, (300, 5))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u"))
    assert all(r["t"] == r["u"] and not any(c in r["e"] for c in CONTROL[:4] + CONTROL[6:11]) for r in df.collect())


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = catalog.QUERIES["op5_quality"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97 and len(rows) > 50
    again = {r["doc_id"]: r["score"] for r in catalog.QUERIES["op5_quality"](spark, sf).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in got.collect())


def test_features_of_repeated_words():
    """A word that repeats the word before it has all its own features again, and a mark beside each."""
    f = Features()
    bags = lambda *texts: [np.bincount(at, minlength=f.buckets) for at, doc in [hashed_features([t.encode() for t in texts], f)]
                           for at in [at[doc == i] for i in range(len(texts))]]
    one, three, other, mixed = bags("spam", "spam spam spam", "eggs", "spam spam eggs")
    mark = np.zeros(f.buckets, int)
    mark[int(_AGAIN) & (f.buckets - 1)] = 1
    assert one.sum() == 1 + 4 + 3 and (three == 3 * one + 16 * mark).all()      # a word, " sp spa pam am ", " spa spam pam "
    assert (mixed == 2 * one + other + 8 * mark).all()


def plain_features(text, f):
    """Buckets of a text's features, one at a time, in whole Python numbers."""
    def mixed(x):
        for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * mul % 2**64
        return x ^ x >> 31

    def of_word(w):
        b = w.encode("utf-8", "surrogatepass")
        return mixed((sum(int(_BYTE[c]) * pow(_BASE, i, 2**64) for i, c in enumerate(b)) + len(b) * 0xE7037ED1A0B428DB) % 2**64)

    def of_gram(g):
        h = len(g)
        for j, c in enumerate(g):
            h = (h ^ ord(c) * int(_MUL[j % 5]) % 2**32) * 0xCC9E2D51 % 2**32
            h ^= h >> 15
        return h

    white = " \t\n\x0b\x0c\r"
    words, out = re.split(f"[{white}]+", text.strip(white)) if text.strip(white) else [], []
    repeats = [i > 0 and w == words[i - 1] for i, w in enumerate(words)]
    out += [of_word(w) for w in words] + [int(_AGAIN) for again in repeats if again]
    padded, word = " " + "".join(" " if c in white else c for c in text) + " ", -1
    for i, c in enumerate(padded):
        begins = c != " " and padded[i - 1] == " "
        word += begins
        of = word + (c == " ")
        for n in f.ngrams:
            g = padded[i:i + n]
            if len(g) == n and " " not in g[1:-1]:
                out += [of_gram(g)] + [int(_AGAIN)] * repeats[of]
    return [h % f.buckets for h in out]


def test_quality_against_a_plain_classifier(spark):
    """Features, gradient descent and scores again, one feature and one number at a time."""
    rng = np.random.default_rng(8)
    f, dim, epochs, rate, seed = Features(buckets=256), 3, 2, 1.5, 5
    good, bad = ["the", "house", "stands", "é🙂", "near"], ["buy", "$$$", "now", "now", "x"]
    rows = [(i, (" ", "\n", " \t ")[i % 3].join(rng.choice(good if i % 3 else bad, rng.integers(1, 12))), int(i % 3 > 0)) for i in range(45)] + [(45, "", 0), (46, " \n ", 1), (47, "now now now", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit_quality(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"), features=f, per_class=1000, dim=dim, epochs=epochs, rate=rate, seed=seed)
    bags = [sorted(plain_features(t, f)) for _, t, _ in rows]
    r = np.random.default_rng(seed)
    vectors = [[float(x) for x in row] for row in r.uniform(-1 / dim, 1 / dim, (f.buckets, dim)).astype(np.float32)]
    matrix, bias, step = [[0.0, 0.0] for _ in range(dim)], [0.0, 0.0], 0
    for _ in range(epochs):
        for i in r.permutation(len(rows)):
            bag, label = bags[i], rows[i][2]
            lr, step = rate * (1 - step / (epochs * len(rows))), step + 1      # all labelled texts are learnt from, so the shares agree
            hidden = [sum(vectors[b][d] for b in bag) / max(1, len(bag)) for d in range(dim)]
            logit = [sum(hidden[d] * matrix[d][c] for d in range(dim)) + bias[c] for c in (0, 1)]
            p = [1 / (1 + math.exp(logit[1 - c] - logit[c])) - (c == label) for c in (0, 1)]
            back = [matrix[d][0] * p[0] + matrix[d][1] * p[1] for d in range(dim)]
            for d in range(dim):
                for c in (0, 1):
                    matrix[d][c] -= lr * hidden[d] * p[c]
                for b in bag:
                    vectors[b][d] -= lr * back[d] / len(bag)
            bias = [bias[c] - lr * 0.1 * p[c] for c in (0, 1)]
    got = {x["doc_id"]: x["score"] for x in with_quality(docs, model).collect()}
    for (i, _, _), bag in zip(rows, bags, strict=True):
        s = sum(vectors[b][d] * (matrix[d][1] - matrix[d][0]) for b in bag for d in range(dim)) / max(1, len(bag)) + bias[1] - bias[0]
        assert abs(got[i] - 1 / (1 + math.exp(-s))) < 1e-4
    assert max(got.values()) - min(got.values()) > 0.05


def test_quality_of_odd_inputs(spark):
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate([*ODD, None])] + [(None, "x", None), (0, "", 1.0)], "doc_id long, text string, SCORE double")
    none = fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    one = fit_quality(docs, spark.createDataFrame([(0, 1), (1, 1), (2, None), (3, 5)], "doc_id long, quality int"))
    both = fit_quality(docs, spark.createDataFrame([(2, 1), (3, 1), (8, 0), (8, 0), (None, 1), (777, 0)], "doc_id long, quality int"))
    for model, want in ((none, 0.5), (one, 1.0), (both, None)):
        got = with_quality(docs, model)
        assert got.columns == ["doc_id", "text", "score"]
        s = [r["score"] for r in got.collect()]
        assert len(s) == docs.count() and all(0 <= x <= 1 for x in s) and (want is None or np.allclose(s, want))
    assert docs.limit(0).select(quality_score(F.col("text"), both)).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer
    path = catalog.tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    sample = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = [(i, t) for i, t in enumerate([*ODD, None, *sample])] + [(None, "no id"), (3, ODD[3])]
    got = pack(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3), path, size=512, block=4000).toPandas()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    for i, docs in want.items():
        own = got[got.doc_id.isna() if i is None else got.doc_id == i].sort_values(["start", "sequence_id"])
        if len(docs) == 1:
            assert own.start.tolist() == np.cumsum([0, *own.length])[:-1].tolist() and (own.doc_tokens == len(docs[0])).all()
            assert b"".join(own.ids) == docs[0].tobytes()
        assert own.length.sum() == sum(map(len, docs))
    padding = 0
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s.offset.tolist() == np.cumsum([0, *s.length])[:-1].tolist()
        n = int(s.length.sum())
        assert n <= 512
        padding += 0 if n & (n - 1) == 0 else 512 - n
    assert padding < 0.05 * got.length.sum()
    assert pack(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


def test_best_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(200):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 8, rng.integers(1, 14)))])
        pen = rng.choice([0.0, 2.0, 9.0], len(at))
        cost = [0.0] + [np.inf] * (len(at) - 1)
        for j in range(1, len(at)):
            cost[j] = min(cost[i] + 10 - (at[j] - at[i]) + pen[j] for i in range(j) if at[j] - at[i] <= 10)
        cuts, last, total = best_cuts(at, pen, 10), 0, 0.0
        for j in cuts:
            assert at[j] - at[last] <= 10
            total += 10 - (at[j] - at[last]) + pen[j]
            last = j
        assert last == len(at) - 1 and np.isclose(total, cost[-1])


def test_pieces(spark):
    path = catalog.tokenizer_file("piece_bpe_32k.model")
    m = PieceModel(path)
    sample = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [*ODD, None, *sample, *ODD]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, IDS int").repartition(3)
    coded = with_pieces(docs, path)
    assert coded.columns == ["doc_id", "text", "ids"]
    assert with_pieces(docs, path, decoded_col="Text2").columns == ["doc_id", "text", "ids", "Text2"]
    got = with_pieces(docs, path, decoded_col="again").withColumn("back", decode_pieces(F.col("ids"), path)).collect()
    assert all(r["again"] == r["back"] for r in got)
    assert len(got) == len(texts)
    for r in got:
        assert r["ids"] == (None if r["text"] is None else m.processor.encode(r["text"])), r["text"][:40]
        assert r["back"] == (r["text"] and r["text"].replace("▁", " "))     # the library reads the mark as a space, too
    assert with_pieces(docs.limit(0), path).count() == 0


def test_viterbi_agrees_with_merging():
    m = PieceModel(catalog.tokenizer_file("piece_bpe_32k.model"))
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abeinrst▁ésch"), rng.integers(1, 12))) for _ in range(500)]
    words = [w.lstrip("▁").replace("▁", "") or "▁" for w in words]
    for w, ids in zip(words, m.encode_words(words), strict=True):
        assert [m.pieces[i] for i in ids] == m.merged(w)


def test_nearest(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((900, 16)) * rng.uniform(0.2, 3, (900, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (920, [0.0] * 16), (940, [float("nan")] * 16), (960, [None] * 16), (None, [1.0] * 16), (980, [1.0, 2.0]), (981, [1.0, 2.0]), (982, [2.0, 4.0]), (1000, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, Score int").repartition(4)
    got = nearest(df, k=20, candidates=250, shard_rows=300)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    by = {}
    for r in got.collect():
        by.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(by) == {*range(0, 900, 20), 980}
    assert [by[980][k] for k in sorted(by[980])] == [(982, 10.0), (981, 5.0)]
    hit = 0
    for q in range(0, 900, 20):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        assert sorted(by[q]) == list(range(1, 21))
        found = [by[q][k] for k in range(1, 21)]
        assert all(np.isclose(s, x[v] @ x[q]) for v, s in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        hit += len({v for v, _ in found} & set(best.tolist()))
    assert hit / (45 * 20) >= 0.9
    assert nearest(df.limit(0)).count() == 0


def test_nearest_recall_on_the_table(spark):
    """Recall of the registered query, with its production parameters, against brute force."""
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(d.embedding).astype(float), d.vec_id.to_numpy()
    hit = total = 0
    got = catalog.QUERIES["op4_ann_forest"](spark, sf).toPandas()
    for q, own in got.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hit += len(set(own.vec_id) & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum() and hit / total >= 0.9


def lengthened(x, kind):
    """Vectors of length one by factors of the named kind."""
    rng = np.random.default_rng(12)
    f = rng.uniform(0, 1, len(x)) if kind == "uniform" else np.where(np.arange(len(x)) < 5, 1000, 1) if kind == "outliers" else rng.lognormal(0, kind, len(x))
    return x / np.linalg.norm(x, axis=1, keepdims=True) * f[:, None]


@pytest.mark.parametrize("kind", [0, 0.25, 0.5, 1.0, "uniform", "outliers"])
def test_forest_recall_of_a_whole_shard(kind):
    """A full shard with the production parameters; two thirds of the rows are scored at most (the ranges of one step more than asked)."""
    x = lengthened(np.random.default_rng(5).standard_normal((8192, 64)), kind)
    f, queries = Forest(np.arange(8192), x, 32, 11), np.arange(0, 8192, 80)
    hit = scored = 0
    for q, found in zip(queries, f.candidates(x[queries], 4000), strict=True):
        score = np.where(f.ids == q, -np.inf, f.x @ x[q])
        hit += np.count_nonzero(found[np.argpartition(-score, 20)[:20]])
        scored += np.count_nonzero(found)
    assert hit / (20 * len(queries)) >= 0.9 and 4000 <= scored / len(queries) <= 2 / 3 * 8192


@pytest.mark.parametrize("kind,candidates", [(0.25, 4000), (0.5, 2000), (1.0, 2000)])
def test_nearest_recall_over_whole_shards(spark, kind, candidates):
    """Three shards of about 8192 rows of unequal norms, searched with half and with a quarter of their rows."""
    n = 3 * 8192
    x = lengthened(np.random.default_rng(6).standard_normal((n, 64)), kind)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)}))
    got = nearest(df, queries=F.col("vec_id") % 240 == 0, candidates=candidates).toPandas()
    hit = 0
    for q, own in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(set(own.vec_id) & set(np.argpartition(-score, 20)[:20].tolist()))
    assert got.query_id.nunique() == -(-n // 240) and hit / len(got) >= 0.9 and len(got) == 20 * -(-n // 240)


def test_packed_ids_match_crc(spark):
    got = catalog.QUERIES["op7_packing"](spark, "/root/testdata/sf0.001")
    raw = pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), catalog.tokenizer_file("word_bpe_49k.json"))
    want = {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in raw.collect()}
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in got.collect()} == want
    assert os.path.exists(catalog.tokenizer_file("word_bpe_49k.json"))
