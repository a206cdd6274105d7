"""N-gram Jaccard join: near-duplicate classes by a grouped prefix join.

A document is the set of its distinct ``k``-word shingles (64-bit hashes of
lower-cased words; one shingle of the whole text if that is shorter).  Two
documents link when 100 * intersection >= percent * union.

Method.
1. Documents with equal sets (128-bit sum of their shingles) are one node.
2. Shingles are ordered rare first (a sketch of all texts' counts, then hash).
   Two linking sets of n and m shingles share at least c = min(_COMMON, ceil(t n),
   ceil(t m)) of their first n - ceil(t n) + _COMMON (and m - ...), the prefix; sets of
   like size share more of them (``_need``).
3. Nodes with the same prefix and size form one group, and only a group's first
   document in a partition sends its prefix: one row per token and group.
   Tokens that one group alone has are dropped where they meet.
4. Group pairs are expanded to their members; member pairs are filtered by size,
   by the number of tokens they share, and by a 1024-bit parity map, which bounds the overlap from above, and
   verified on their whole texts (which travel compressed).
5. Not all pairs of a large class are made.  First every group on a token meets
   only the token's smallest and largest group; verified links give components.
   That is repeated with components in the place of groups while it finds links,
   the pairs left are many and a round leaves at most half as many, and finally the groups of different components on the same token meet each
   other.  A pair inside one component cannot change the classes, so none
   that matters is left out.
6. Before groups of different components meet, tokens of one component alone and
   nodes with fewer tokens left than a link asks for (c, the least for the sizes that
   their tokens have elsewhere) are taken out, and each node gives up its
   c - 1 most frequent tokens (by their exact counts there): of the c tokens that
   a link shares the rarest stays in both.  A row carries the node's rarer tokens next to its
   own, so a pair is met at its rarest common token.  Only pairs that share as many tokens as
   their sizes ask for, by the nodes' token lists, are fetched.
7. Copies that are measured to be small are read as one partition, and steps on them
   alone need no exchange; larger ones are shuffled.

A token's groups are read as a stream, and minima per token are aggregated before
the shuffle; no group is collected.

Defined cases: null, empty and white-space-only texts have the empty set and
link with nothing; rows with a null id take part, and a class's id is the
smallest id that is not null; repeated rows are one node and are all returned; very
long texts are split whole, a text being the least that a task holds;
an empty table gives an empty result; input columns other than id and text are
not returned by ``near_classes``.  ``one_of_each`` keeps one row of each class:
of the smallest id that is not null, then of the smallest text hash, and of rows
equal in both any one.  A text without words is a class of its own, but rows
with the same id and the same such text (null counts as empty) are one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, chunks, discard, gathered, id_and_text, is_small, together
from strata.llm.components import components
from strata.llm.sketch import shingle_classes
from strata.llm.wordhash import U, doc_shingles, mix, split_words

_MAP_WORDS = 16  # 64-bit words of a parity map


#: Prefix tokens that a linking pair shares at least (if its sets are large enough).
_COMMON = 8
#: Tokens on which a group and the token's first or last group meet before they are compared early; pairs on fewer come last.
_EARLY = 3


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + _COMMON)


def set_id(s: np.ndarray) -> bytes:
    """128 bits of a set of hashes, whatever their order."""
    return np.array([len(s), mix(s).sum(dtype=U), mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)], ">u8").tobytes()[4:]


def parity_map(s: np.ndarray) -> list[int]:
    bits = np.bincount((mix(s) >> U(54)).astype(np.int64), minlength=64 * _MAP_WORDS) & 1
    return np.packbits(bits).view(np.int64).tolist()


def ordered(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rare shingles first, then by hash."""
    return s[np.lexsort((s, classes[(s & U(len(classes) - 1)).astype(np.int64)]))]


def _signatures(k: int, percent: int, classes: np.ndarray):
    """(id, h, node, n, gid, parity map, prefix) of each document; the prefix of a group goes with its first document in a partition alone."""
    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            for rows, texts in chunks(list(range(batch.num_rows)), batch.column(1).to_pylist()):
                out = []
                for s in doc_shingles(split_words(texts, lower=True), k):
                    if len(s):
                        head = ordered(s, classes)[:prefix_length(len(s), percent)]
                        g = _group(head, len(s))
                        out.append((set_id(s), len(s), g, parity_map(s), None if g in sent else head.view(np.int64)))
                        sent.add(g)
                    else:
                        out.append((None, 0, None, None, None))
                node, n, g, bits, heads = zip(*out, strict=True)
                part = batch.slice(rows[0], len(rows))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(g, pa.int64()),
                                                  pa.array(bits, pa.list_(pa.int64())), pa.array(heads, pa.list_(pa.int64()))], names=["id", "h", "node", "n", "gid", "bits", "head"])
    return run


def _group(head: np.ndarray, n: int) -> int:
    return int(mix(np.append(head, U(n))).sum(dtype=U, keepdims=True).view(np.int64)[0])


_PAIRS_A_TASK = 2_000   # verified in one task, if they are few
#: Pairs across components are made outright once there are at most so many per row of a token.
_PAIRS_PER_ROW = 16
_SKETCH_BITS = 20
_HELD = 200_000     # rows of one token held back while it is not known whether another group follows


def _shared(batches):
    """Distinct (token, gid) of tokens that several groups have, from rows sorted by both."""
    rest = np.zeros((2, 0), np.int64)
    known = None        # a token that has shown two groups and of which rows have been given out

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], names=["token", "gid"])

    def wanted(rows):
        token, gid = rows
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (gid[1:] != gid[:-1])])
        token, gid = token[new], gid[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        n = np.diff(np.append(first, len(token)))
        keep = np.repeat((n > 1) | (token[first] == known if known is not None else False), n)
        return np.stack([token[keep], gid[keep]])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([rest, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])], axis=1)
        last = int(np.searchsorted(rows[0], rows[0, -1]))
        if last:
            yield out(wanted(rows[:, :last]))
            known = None if known != rows[0, -1] else known
        rest = rows[:, last:]
        if rest.shape[1] > _HELD and (known is not None or rest[1, 0] != rest[1, -1]):
            known = int(rest[0, 0])
            some = wanted(rest)
            yield out(some[:, :-1])
            rest = some[:, -1:]
    if rest.shape[1]:
        yield out(wanted(rest))


def _packed(batches):
    """(id, h, text compressed, size) of (id, text, h)."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        z = [pa.compress(t, "zstd", asbytes=True) for t in texts]
        n = [len(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(z, pa.binary()), pa.array(n, pa.int64())], names=["id", "h", "z", "size"])


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")


def _verify(k: int, percent: int):
    def run(batches):
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, U))

        def shingle_set(z, size):
            return doc_shingles(split_words([pa.decompress(z, size, "zstd", asbytes=True)], lower=True), k)[0]

        for batch in batches:
            keep = []
            for a, b, za, na, zb, nb in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                if last[0] != a:
                    last = (a, shingle_set(za, na))
                s, t = last[1], shingle_set(zb, nb)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id (smallest id reachable by links, itself included)."""
    sig, root = _classes(docs, id_col, text_col, k, percent)
    low = root.groupBy("root").agg(F.min("id").alias("component_id"))
    out = sig.select("id", "n", "node").join(root.select("node", "root"), "node", "left").join(low, "root", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """One row of ``docs`` for each class."""
    sig, root = _classes(docs, id_col, text_col, k, percent)
    first = root.groupBy("root").agg(F.min("of").alias("of")).select("of.no_id", "of.id", "of.h")
    kept = first.unionByName(sig.where("node is null").select(F.col("id").isNull().alias("no_id"), "id", "h").distinct())
    kept = kept.select("no_id", F.coalesce("id", F.lit(0)).alias("id"), "h")
    own = F.col(f"`{id_col}`").cast("long")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select("*", own.isNull().alias("__no_id"), F.coalesce(own, F.lit(0)).alias("__id"), F.xxhash64(text).alias("__h"))
    on = (rows["__no_id"] == kept["no_id"]) & (rows["__id"] == kept["id"]) & (rows["__h"] == kept["h"])
    return rows.join(kept, on, "left_semi").dropDuplicates(["__no_id", "__id", "__h"]).select(*(F.col(f"`{c}`") for c in docs.columns))


def _classes(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, h, node, n, ...) of every row, and (node, id, of: its first row, root) of every set of shingles."""
    texts = id_and_text(docs, id_col, text_col)
    classes = shingle_classes(texts, k, True, bits=_SKETCH_BITS)
    texts = texts.withColumn("h", F.xxhash64("text"))
    sig = checkpoint(texts.mapInArrow(_signatures(k, percent, classes), "id long, h long, node binary, n long, gid long, bits array<long>, head array<long>"))
    nodes = sig.where("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("of"),
        *(F.first(c).alias(c) for c in ("gid", "n", "bits")))
    nodes = checkpoint(nodes.withColumn("nid", F.monotonically_increasing_id()))     # fixed once it is written

    post = sig.where("head is not null").select(F.explode("head").alias("token"), "gid")
    post = gathered(checkpoint(post.repartition("token").sortWithinPartitions("token", "gid").mapInArrow(_shared, "token long, gid long")))

    # members of the groups that have such a token, or several members
    many = nodes.groupBy("gid").agg(F.count("*").alias("k"), F.min("nid").alias("head"))
    used = many.join(post.select("gid").distinct().withColumn("shared", F.lit(True)), "gid", "left").where("shared or k > 1")
    member = gathered(checkpoint(nodes.join(used.select("gid", "head", (F.col("k") > 1).alias("many")), "gid").select("gid", "head", "many", "nid", "n", "bits", "of")))
    own = gathered(checkpoint(member.select("gid", "nid", "n")))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the different node pairs (a, b) that link."""
        pairs = gathered(checkpoint(pairs))
        ends = together(pairs.select(F.col("a").alias("nid")).unionByName(pairs.select(F.col("b").alias("nid"))), pairs).distinct()
        m = ends_ = gathered(checkpoint(member.select("nid", "n", "bits", "of").join(F.broadcast(ends) if is_small(pairs) else ends, "nid")))
        x, y = m.select(F.col("nid").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), m.select(F.col("nid").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
        odd = sum((F.bit_count(F.get("ba", F.lit(i)).bitwiseXOR(F.get("bb", F.lit(i)))) for i in range(_MAP_WORDS)), F.lit(0))
        # every element of one set alone flips a bit: union - intersection >= odd
        p = pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        p = p.where((100 + percent) * (F.col("na") + F.col("nb") - odd) >= 2 * percent * (F.col("na") + F.col("nb"))).select("a", "b")
        p = open_ = gathered(checkpoint(p, pairs))
        # only texts of pairs that are still open are fetched
        need = together(p.select(F.col("a").alias("nid")).unionByName(p.select(F.col("b").alias("nid"))), p).distinct().join(m.select("nid", "of"), "nid")
        need = wanted = gathered(checkpoint(need, ends_))
        few = is_small(need)
        if few:      # no text is packed or shuffled that no pair needs
            some = texts.join(F.broadcast(need), texts["id"].eqNullSafe(F.col("of.id")) & (texts["h"] == F.col("of.h"))).select("nid", "text", texts["h"])
            text = some.mapInArrow(_packed, "id long, h long, z binary, size long").withColumnRenamed("id", "nid")
        else:
            packed = texts.mapInArrow(_packed, "id long, h long, z binary, size long")
            text = packed.join(need, packed["id"].eqNullSafe(F.col("of.id")) & (packed["h"] == F.col("of.h")))
        text = text.select("nid", "z", "size").dropDuplicates(["nid"])
        copy = None
        if few and is_small(open_):     # pairs are dealt out to the texts, not both by their keys
            text = copy = checkpoint(text)
            text, p = (F.broadcast(text), p.repartition(1 + open_.count() // _PAIRS_A_TASK)) if is_small(copy) else (text, p)
        p = (p.join(text.select(F.col("nid").alias("a"), F.col("z").alias("za"), F.col("size").alias("sa")), "a")
             .join(text.select(F.col("nid").alias("b"), F.col("z").alias("zb"), F.col("size").alias("sb")), "b").select("a", "b", "za", "sa", "zb", "sb"))
        return gathered(checkpoint(p.mapInArrow(_verify(k, percent), "a long, b long"), open_, wanted, *([copy] if copy is not None else [])))

    def met(pairs: DataFrame, least: Column) -> DataFrame:
        """Pairs (a, b), a < b, that meet on at least so many tokens; one row per token and pair comes in, a column more may bound it."""
        both = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), least.alias("least"))
        return both.groupBy("a", "b").agg(F.count("*").alias("c"), F.first("least").alias("least")).where("c >= least").select("a", "b")

    def tips(rows: DataFrame, copy: DataFrame) -> DataFrame:
        """Rows (token, part, key) against the first and the last part on their token, other parts only."""
        star = rows.join(rows.groupBy("token").agg(F.min(F.struct("part", "key")).alias("low"), F.max(F.struct("part", "key")).alias("high")), "token")
        ends = [star.where(F.col("part") != F.col(f"{e}.part")).select(F.col("key").alias("a"), F.col(f"{e}.key").alias("b")) for e in ("low", "high")]
        return together(ends[0].unionByName(ends[1]), copy)

    def joined(comp: DataFrame) -> DataFrame:
        """Edges that say the same as the links that gave the components."""
        return comp.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))

    # every group meets the smallest and the largest group on its tokens; a group's members meet its first one
    groups = met(tips(post.select("token", F.col("gid").alias("part"), F.col("gid").alias("key")), post), F.lit(_EARLY))
    first = (groups.join(own.select(F.col("gid").alias("a"), F.col("nid").alias("x")), "a").join(own.select(F.col("gid").alias("b"), F.col("nid").alias("y")), "b")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    first = first.unionByName(member.where("nid <> head").select(F.least("nid", "head").alias("a"), F.greatest("nid", "head").alias("b")))
    links = linked(first)

    # then only what lies in different components; the members of one group share all its tokens
    shared = post.join(own, "gid").select("token", "nid", "n")
    alone = member.where("many").select("gid", "nid", "n")
    left = None     # pairs that the round before had left
    while True:
        comp = components(links)
        rooted = shared.join(comp, F.col("nid") == F.col("node"), "left").select("token", "nid", "n", F.coalesce("root", "nid").alias("root"))
        rows = _peeled(rooted, percent)
        kept = gathered(checkpoint(_rarest(rows)))
        size = kept.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
        size = size.agg(F.sum("k"), F.sum(F.col("k") * F.col("k") - F.col("kk"))).first()
        if size[0] and size[1] > 2 * _PAIRS_PER_ROW * size[0] and (left is None or 2 * size[1] <= left):
            left = size[1]
            more = linked(met(tips(rows.select("token", F.col("root").alias("part"), F.col("nid").alias("key")), rows), F.lit(_EARLY)))
            if not more.isEmpty():      # each joins two components
                links = gathered(checkpoint(joined(comp).unionByName(more), links, more, rows, kept, comp))
                continue
        held = rows.groupBy("nid").agg(F.collect_list("token").alias("tokens"))
        pairs = (_cross(kept, percent, once=True).distinct().join(held.select(F.col("nid").alias("a"), F.col("tokens").alias("ta")), "a")
                 .join(held.select(F.col("nid").alias("b"), F.col("tokens").alias("tb")), "b").where(F.size(F.array_intersect("ta", "tb")) >= F.col("least")))
        # a group of several members whose tokens no other group has: its members in different components
        inner = alone.join(comp, F.col("nid") == F.col("node"), "left").select(F.col("gid").alias("token"), "nid", "n", F.coalesce("root", "nid").alias("root"))
        pairs = pairs.select("a", "b").unionByName(_cross(inner, percent).select("a", "b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        last = linked(pairs)
        links = gathered(checkpoint(joined(comp).unionByName(last), links, last, rows, kept, comp))
        break
    discard(post, member, own)

    comp = components(links)
    root = nodes.select("node", "nid", "id", "of").join(comp.withColumnRenamed("node", "member"), F.col("nid") == F.col("member"), "left").withColumn("root", F.coalesce("root", "nid"))
    return sig, root


def _cross(rows: DataFrame, percent: int, once: bool = False) -> DataFrame:
    """Node pairs on one token whose components differ and whose sizes fit, with the overlap that the larger set asks for.

    ``once``: only where no token that both rows carry in ``before`` is the same.  The rarest common token of a pair is never
    left out by that, and of pairs with up to ``_BEFORE`` tokens a node every other one is.
    """
    x, y = rows.alias("x"), rows.alias("y")
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") < F.col("y.root")) & _sizes_fit("x", "y", percent)
    p = x.join(y, on & ~F.arrays_overlap("x.before", "y.before") if once else on)
    return p.select(F.col("x.nid").alias("a"), F.col("y.nid").alias("b"), _need(F.col("x.n"), F.col("y.n"), percent).alias("least"))


def _need(n: Column, m: Column, percent: int) -> Column:
    """Prefix tokens that linking sets of n and m elements share at least.

    Of what they share, the set whose prefix ends first in the order of tokens holds at most its elements after the prefix
    outside of both prefixes.
    """
    overlap = F.ceil(percent * (n + m) / (100 + percent) - 1e-9)
    return overlap - F.greatest(F.lit(0), F.ceil(percent * F.greatest(n, m) / 100) - _COMMON)


def _own_need(percent: int) -> Column:
    """Prefix tokens that a node of n elements shares at least with any of the sizes lo to hi that it links with."""
    n, lo, hi = F.col("n"), F.col("lo"), F.col("hi")
    # grows with a smaller partner's size, falls with a larger one's but for rounding
    small, large = F.greatest(F.least(lo, n), F.floor(percent * n / 100)), F.least(F.greatest(hi, n), F.ceil(100 * n / percent))
    return F.least(_need(n, small, percent), _need(n, large, percent) - F.when(large > n, 1).otherwise(0))


def _peeled(rows: DataFrame, percent: int) -> DataFrame:
    """Of rows (token, nid, n, root) those that a link of two components can need, with need, the node's tokens that a link asks for, and k, the rows on their token.

    A token goes that stands in one component alone, and then a node that has fewer tokens left than a link asks for, by the
    sizes that its tokens' rows have; then again a token.
    """
    one = (F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = rows.groupBy("token").agg(*one, F.min("n").alias("lo"), F.max("n").alias("hi")).where("low <> high").select("token", "lo", "hi")
    first = gathered(checkpoint(rows.join(mixed, "token")))
    enough = first.groupBy("nid").agg(F.count("*").alias("c"), F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    enough = enough.select("nid", "c", _own_need(percent).cast("int").alias("need")).where("c >= need").select("nid", "need")
    rows = first.select("token", "nid", "n", "root").join(enough, "nid")
    mixed = rows.groupBy("token").agg(*one, F.count("*").alias("k")).where("low <> high").select("token", "k")
    return gathered(checkpoint(rows.join(mixed, "token"), first))


#: Tokens before its own that a row carries.
_BEFORE = 32


def _rarest(rows: DataFrame) -> DataFrame:
    """Each node without its most frequent tokens, one less than a link asks for: the rarest token that a link's two nodes share stays in both.

    ``before`` holds the node's rarer tokens, by which a pair that shares several is met once.
    """
    node = Window.partitionBy("nid").orderBy(F.desc("k"), "token")
    few = rows.withColumns({"place": F.row_number().over(node), "before": F.collect_list("token").over(node.rowsBetween(1, _BEFORE))})
    return few.where("place >= need").select("token", "nid", "n", "root", "before")
