"""Exact Jaccard self-join of documents on word shingles with signature trees; result: connected components.

Texts with the same set of shingles are one class; all further work is on one representative per class. A class is a
leaf with its size and a bitmap of its tokens, two to four bits per token, and as many parities. The root of each tree is a token: two sets
with a Jaccard similarity of t or more share one of the first ``n - ceil(t n) + 1`` of their n tokens in any common order
(here the order of the hashes, tokens of several classes last), so every linked pair meets under some token, and only
tokens that two classes hold there matter. Which tokens are put last changes the work and not the result; a bit filter sized
by their number, of 16 MB at most, says it, and what it takes for one of them is put last too. Under a token come size
bands, under a band blocks of some dozens of classes that are alike: those with one and the same first token of the trees
stay together. A node holds the OR of its leaves' bitmaps, the ranges of their sizes, components and first tokens.

Two passes find the links:

1. Under a token of a few classes, their pairs meet; the number of tokens under which a pair meets must admit a link. Under
   a token of many, each class is compared with the one class there that shares most of its tokens with others. That
   links nearly all of a family of copies without a pair of members, and gives first components. Where a token still has
   several of those, each class outside its largest meets one class of that, another one under each token.
2. A dual traversal of each tree of a token of many classes descends into pairs of nodes: bands, then blocks, then leaves. A pair is pruned if both
   are of one and the same component, if both have one and the same first token (they meet in that token's tree), if the
   size ranges admit no link, or if the largest overlap that the bitmaps admit is below what the smallest sizes need. Leaf
   pairs are pruned by their parities: bits that differ count tokens that differ. Classes in the trees have wider parities, so that
   hardly a pair is left that isn't a link. A pair comes out of one tree only, that of the first token that both have there.
   Leaves are fetched for pairs of blocks that are left.

Pairs that remain in either pass are decided by the sizes of the true intersections, so the bounds cost nothing but
work. No pass drops, caps or samples anything. Token order and bitmaps come from 64-bit hashes of shingles, as does the
identity of a class; two different shingles or sets with one hash are taken as equal (odds below n^2 / 2^65).

Defined cases: null and empty texts have no shingles and stand alone, with their own id as component; a null id counts as
larger than any id; rows repeated with one id give a row each; an empty table gives an empty result; texts of any length
are read whole. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import scope, settle
from .common import BITMAP_BITS, components, flag_keys, key_filter, settle_in_small_batches, text_of
from .shingles import mixed, shingle_sets

#: Leaves of a block, on average.
BLOCK = 48
#: Tokens under more classes than this go to the end of the common order.
COMMON = 3
#: Under a token of at most so many classes all its pairs are met; beyond it a tree is built.
FEW = 8
#: Rows of an Arrow batch where a row holds blocks of bitmaps.
BATCH_ROWS = 64
#: Documents of an Arrow batch; those whose shingles are held at once, if a batch has more.
PORTION = 1024
BITS_PER_TOKEN = 2
#: The same for the parities of classes in trees, up to so many bits of a class unless it has more by the former rule.
TREE_BITS_PER_TOKEN, TREE_BITS = 8, 1 << 16
#: A key filter has 16 bits or more per key, up to so many buckets of 4 kB; beyond that it lets more keys through.
MOST_BUCKETS = 4096
#: Bytes of bitmaps compared at once.
COMPARED = 1 << 22


def _class(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m tokens whose Jaccard similarity is ``percent`` per cent or more."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Tokens in common order among which a linked set must share one."""
    return n - -(-percent * n // 100) + 1


def _width(n: int, bits: int) -> int:
    return 1 << max(6, int(bits * n - 1).bit_length())


def signature(tokens: np.ndarray) -> bytes:
    """Bitmap of the tokens; its width is a power of two of at least two bits per token."""
    width = _width(len(tokens), BITS_PER_TOKEN)
    bits = np.zeros(width, dtype=bool)
    bits[(mixed(tokens) >> np.uint64(7)).astype(np.int64) & (width - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def parity(tokens: np.ndarray, bits: int = BITS_PER_TOKEN) -> bytes:
    """Bitmap of so many bits per token, each the parity of the tokens there; what differs in two counts differing tokens closely."""
    width = max(_width(len(tokens), BITS_PER_TOKEN), min(_width(len(tokens), bits), TREE_BITS))
    at = (mixed(tokens) >> np.uint64(7)).astype(np.int64) & (width - 1)
    return np.packbits((np.bincount(at, minlength=width) & 1).astype(bool), bitorder="little").tobytes()


def _number(bits: bytes, width: int) -> int:
    """The bitmap as an integer, folded to ``width`` bytes; a power-of-two table folds by OR of its halves."""
    x, have = int.from_bytes(bits, "little"), len(bits)
    while have > width:
        have //= 2
        x = (x >> (8 * have)) | (x & ((1 << (8 * have)) - 1))
    return x


def may_link(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """Whether sizes and parities admit a link: each differing bit stands for a token that only one set has."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    width = min(len(a), len(b))
    x, y = _folded(a, width), _folded(b, width)
    most = n + m - 2 * needed(n, m, percent)  # tokens that may differ
    return int(np.bitwise_count(x ^ y).sum()) <= most


def _folded(bits: bytes, width: int) -> np.ndarray:
    """The parities as 64-bit words, folded to ``width`` bytes by XOR of the halves."""
    words = np.frombuffer(bits, np.uint64)
    return words if len(bits) == width else np.bitwise_xor.reduce(words.reshape(-1, width // 8), axis=0)


def portions(batches):
    """The batches in slices of a number of rows whose shingles fit in memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, PORTION):
            yield batch.slice(at, PORTION)


def leading(tokens: np.ndarray, percent: int, last: np.ndarray) -> np.ndarray:
    """The first tokens in common order: those not in the bit filter ``last`` by hash, then the others."""
    if len(last):
        at = (tokens & np.uint64(8 * len(last) - 1)).astype(np.int64)
        common = (last[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        tokens = np.concatenate([tokens[~common], tokens[common]])
    return tokens[: prefix_length(len(tokens), percent)]


def shingle_keys(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, n, class, first tokens by hash) of every document."""
    none = np.zeros(0, np.uint8)

    def run(batches):
        for batch in portions(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            prefixes = [leading(s, percent, none).view(np.int64) if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["id", "n", "c", "prefix"],
            )

    return docs.select("id", "text").mapInArrow(run, f"id {dict(docs.dtypes)['id']}, n long, c long, prefix array<long>")


def leaves_of(docs: DataFrame, words: int, percent: int, last: np.ndarray) -> DataFrame:
    """(c, n, prefix, sig, odd) of every document with shingles. ``last``: bit filter of tokens at the end of the order."""
    shared = docs.sparkSession.sparkContext.broadcast(last)  # MOST_BUCKETS of 4 kB at most

    def run(batches):
        for batch in portions(batches):
            sets = [s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)]
            prefixes = [leading(s, percent, shared.value).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_class(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array([signature(s) for s in sets], pa.binary()),
                    pa.array([parity(s) for s in sets], pa.binary()),
                ],
                names=["c", "n", "prefix", "sig", "odd"],
            )

    return docs.select("text").mapInArrow(run, "c long, n long, prefix array<long>, sig binary, odd binary")


def token_sets(docs: DataFrame, words: int) -> DataFrame:
    """(c, tokens) of every document with shingles."""

    def run(batches):
        for batch in portions(batches):
            sets = [s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["c", "tokens"],
            )

    return docs.select("text").mapInArrow(run, "c long, tokens array<long>")


def tree_parities(docs: DataFrame, words: int) -> DataFrame:
    """(c, odd) of every document with shingles, ``odd`` as wide as the trees have it."""

    def run(batches):
        for batch in portions(batches):
            sets = [s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class(s) for s in sets], pa.int64()), pa.array([parity(s, TREE_BITS_PER_TOKEN) for s in sets], pa.binary())],
                names=["c", "odd"],
            )

    return docs.select("text").mapInArrow(run, "c long, odd binary")


def buckets_for(keys: DataFrame) -> int:
    """Buckets of a key filter for a written table of keys, a power of two."""
    return min(MOST_BUCKETS, 1 << max(0, -(-16 * keys.count() // BITMAP_BITS) - 1).bit_length())


def only(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be in the written table ``wanted``, by a broadcast filter of bounded size; no shuffle of the texts."""
    buckets = buckets_for(wanted)
    return flag_keys(docs, key, key_filter(wanted, key, buckets), "_in", buckets).where("_in").drop("_in")


def filter_bytes(keys: DataFrame, key: str) -> np.ndarray:
    """The bits of a key filter over a written table, empty if that has no rows; MOST_BUCKETS of 4 kB at most reach the driver."""
    buckets = buckets_for(keys)
    out = np.zeros(buckets * BITMAP_BITS // 8, np.uint8)
    rows = key_filter(keys, key, buckets).collect()
    for row in rows:
        at = (row["_bucket"] - 1) * BITMAP_BITS // 8
        out[at : at + len(row["_bits"])] = np.frombuffer(row["_bits"], np.uint8)
    return out if rows else out[:0]


def bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parities admit."""

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("na", "sa", "nb", "sb"))
            keep = [may_link(na, sa, nb, sb, percent) for na, sa, nb, sb in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("odd").alias("sa"))
    right = nodes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("sb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _nodes(batches):
    """Blocks to nodes: the OR of the leaves' bitmaps, and the most tokens of a leaf that share a bit with another."""
    for batch in batches:
        ors, hidden = [], []
        for members in batch.column("members").to_pylist():
            width = max(len(m["sig"]) for m in members)
            total = most = 0
            for m in members:
                x, have = int.from_bytes(m["sig"], "little"), len(m["sig"])
                most = max(most, m["n"] - x.bit_count())
                while have < width:  # in a wider table the token may be in either half
                    x, have = x | (x << (8 * have)), 2 * have
                total |= x
            ors.append(total.to_bytes(width, "little"))
            hidden.append(most)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hidden, pa.int64()), pa.array(ors, pa.binary())],
            names=[*batch.schema.names, "hidden", "sig"],
        )


def admits(x: dict, y: dict, percent: int) -> bool:
    """Whether two nodes may hold a link, by the largest overlap that their ORs, sizes and components admit."""
    if x["lo"] == x["hi"] == y["lo"] == y["hi"]:
        return False
    if 100 * x["most"] < percent * y["least"] or 100 * y["most"] < percent * x["least"]:
        return False
    width = min(len(x["sig"]), len(y["sig"]))
    shared = (_number(x["sig"], width) & _number(y["sig"], width)).bit_count()
    # a leaf has as many common tokens as common bits, and those of its tokens that share a bit
    folded = width < max(len(x["sig"]), len(y["sig"]))
    return folded or shared + min(x["hidden"], y["hidden"]) >= needed(x["least"], y["least"], percent)


def _leaf_pairs(t: int, xs: list[dict], ys: list[dict] | None, percent: int):
    """Pairs of leaves of different components that the bounds admit and that meet in no earlier tree by their first tokens;
    within one block if ``ys`` is None."""
    left, right = xs, xs if ys is None else ys
    cx, nx, px, fx = (np.array([m[k] for m in left], np.int64)[:, None] for k in ("c", "n", "comp", "f"))
    cy, ny, py, fy = (np.array([m[k] for m in right], np.int64)[None, :] for k in ("c", "n", "comp", "f"))
    open_ = (px != py) & (cx != cy) & ((fx != fy) | (fx == t))
    open_ &= 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
    i, j = np.nonzero(np.triu(open_, 1) if ys is None else open_)
    if not len(i):
        return
    width = min(len(m["odd"]) for m in (*left, *right))
    x, y = (np.stack([_folded(m["odd"], width) for m in side]) for side in (left, right))
    total = nx[i, 0] + ny[0, j]
    most = total - 2 * -(-percent * total // (100 + percent))  # tokens that may differ
    step = max(1, COMPARED // width)
    for at in range(0, len(i), step):
        p, q = i[at : at + step], j[at : at + step]
        keep = np.bitwise_count(x[p] ^ y[q]).sum(axis=1, dtype=np.int64) <= most[at : at + step]
        for a, b in zip(cx[p[keep], 0].tolist(), cy[0, q[keep]].tolist()):
            yield min(a, b), max(a, b)


def met_first(t: int, pairs, leaves: list[dict]):
    """The pairs for which ``t`` is the first token of the trees that both have; ``ts`` holds those of a leaf."""
    of = None
    for a, b in pairs:
        of = of or {m["c"]: m["ts"] for m in leaves}
        for c in (a, b):
            if isinstance(of[c], bytes):
                of[c] = set(np.frombuffer(of[c], np.int64).tolist())
        if min(of[a] & of[b]) == t:
            yield a, b


def token_lists(held: DataFrame) -> DataFrame:
    """(c, f, ts) of rows t, c: the first t of c, and all of them, no more than a row of leading tokens holds, as bytes."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ts")
            ts = [np.asarray(x.values, np.int64) for x in lists]
            columns = [batch.column("c"), pa.array([x.min() for x in ts], pa.int64()), pa.array([x.tobytes() for x in ts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["c", "f", "ts"])

    return held.groupBy("c").agg(F.collect_set("t").alias("ts")).mapInArrow(run, "c long, f long, ts binary")


def tree_pairs(rows: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of leaves that the dual traversal of the tokens' trees leaves.

    ``rows``: t, c, n, comp, f (the first t of c); ``sigs``: c, sig, odd, ts (all t of c). Both written tables.
    """
    band = F.floor(F.log(F.col("n")) / float(np.log(100 / percent))).cast("int")
    banded = rows.withColumn("band", band)
    # leaves with one first token have blocks of their own if they fill one; the others are put together by that token
    alike = settle(banded.groupBy("t", "band", "f").agg(F.count(F.lit(1)).alias("alike")))
    loose = alike.groupBy("t", "band").agg(F.sum(F.when(F.col("alike") < BLOCK, F.col("alike")).otherwise(0)).alias("loose"))
    own = F.col("alike") >= BLOCK
    part = F.when(own, F.pmod(F.xxhash64("c"), F.ceil(F.col("alike") / BLOCK))).otherwise(
        F.pmod(F.xxhash64("f"), F.ceil(F.col("loose") / BLOCK))
    )
    sizes = settle(alike.join(loose, ["t", "band"]))
    placed = settle(
        banded.join(sizes, ["t", "band", "f"])
        .withColumn("block", F.xxhash64(F.when(own, F.col("f")), part))
        .select("t", "band", "block", "c", "n", "comp", "f")
    )
    member = F.struct("c", "n", "comp", "f", "sig", "odd", "ts")
    grouped = placed.join(sigs, "c").groupBy("t", "band", "block").agg(
        F.collect_list(member).alias("members"),  # BLOCK leaves on average
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
        F.min("f").alias("flo"),
        F.max("f").alias("fhi"),
    )
    schema = T.StructType([*grouped.schema.fields, T.StructField("hidden", T.LongType()), T.StructField("sig", T.BinaryType())])
    built = grouped.mapInArrow(_nodes, schema)
    nodes = settle_in_small_batches(built.withColumn("members", F.transform("members", lambda m: m.dropFields("sig"))), BATCH_ROWS)

    def inside(batches):
        for batch in batches:
            found = set()
            for x in batch.to_pylist():
                found.update(met_first(x["t"], _leaf_pairs(x["t"], x["members"], None, percent), x["members"]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def admitted(batches):
        for batch in batches:
            keep = [admits(row["x"], row["y"], percent) for row in batch.to_pylist()]
            yield batch.drop_columns(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    def across(batches):
        for batch in batches:
            found = set()
            for x in batch.to_pylist():
                found.update(met_first(x["t"], _leaf_pairs(x["t"], x["xs"], x["ys"], percent), x["xs"] + x["ys"]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    # upper nodes: a band of a token with the range of its components; pairs of one component go before blocks are paired
    bands = nodes.groupBy("t", "band").agg(F.min("lo").alias("blo"), F.max("hi").alias("bhi"), F.count(F.lit(1)).alias("blocks"))
    bands = settle(bands)
    other = bands.select("t", F.col("band").alias("band2"), F.col("blo").alias("blo2"), F.col("bhi").alias("bhi2"), F.col("blocks").alias("blocks2"))
    band_pairs = bands.join(other, "t").where(
        "(band2 = band and blocks > 1 or band2 = band + 1) and least(blo, blo2) != greatest(bhi, bhi2)"
    )
    # blocks are paired by their nodes; the leaves follow for the pairs that the nodes admit, by the block's own key
    bounds = F.struct("least", "most", "lo", "hi", "flo", "fhi", "hidden", "sig")
    x = nodes.select("t", "band", "block", bounds.alias("x"))
    y = nodes.select("t", F.col("band").alias("band2"), F.col("block").alias("block2"), bounds.alias("y"))
    block_pairs = (
        settle(band_pairs.select("t", "band", "band2"))
        .join(x, ["t", "band"])
        .join(y, ["t", "band2"])
        .where("(band != band2 or block < block2) and least(x.lo, y.lo) != greatest(x.hi, y.hi)")
        .where("least(x.flo, y.flo) != greatest(x.fhi, y.fhi) or x.flo = t")
        .where((F.col("x.most") * 100 >= F.col("y.least") * percent) & (F.col("y.most") * 100 >= F.col("x.least") * percent))
    )
    places = T.StructType([f for f in block_pairs.schema.fields if f.name not in ("x", "y")])
    block_pairs = settle_in_small_batches(block_pairs.mapInArrow(admitted, places), BATCH_ROWS)
    xs = nodes.select("t", "band", "block", F.col("members").alias("xs"))
    ys = nodes.select("t", F.col("band").alias("band2"), F.col("block").alias("block2"), F.col("members").alias("ys"))
    leaves = block_pairs.join(xs, ["t", "band", "block"]).join(ys, ["t", "band2", "block2"])
    near = nodes.where("lo != hi and (flo != fhi or flo = t)").select("t", "members").mapInArrow(inside, "a long, b long")
    far = leaves.select("t", "xs", "ys").mapInArrow(across, "a long, b long")
    return settle_in_small_batches(near.unionAll(far).distinct(), BATCH_ROWS)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links reach)."""
    # of all tables on the way only the keys and the components are left; those of a phase go when it ends
    with scope(docs.sparkSession) as keep:
        base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        hashed = base.withColumn("k", F.xxhash64("id"))
        with scope(docs.sparkSession) as keep_keys:
            first = settle_in_small_batches(shingle_keys(base, words, percent), PORTION)
            keys = keep(first.select("id", "n", "c"))
            grouped = keys.where("c is not null").groupBy("c").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
            classes = keep_keys(grouped)
            chosen = keep_keys(classes.select(F.xxhash64("id").alias("k")))
            tokens = only(first.withColumn("k", F.xxhash64("id")), "k", chosen).select(F.explode("prefix").alias("t"))
            usual = settle(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > COMMON).select("t"))
            last = filter_bytes(usual, "t")

        # one representative's text per class: by a filter on its id; what that lets through besides only repeats a leaf
        reps = only(hashed, "k", chosen)
        nodes = settle_in_small_batches(leaves_of(reps, words, percent, last).dropDuplicates(["c"]), PORTION)
        counts = settle(nodes.select(F.explode("prefix").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
        tokens = nodes.select(F.explode("prefix").alias("t"), "c", "n")
        rows = settle(only(tokens, "t", counts).join(counts, "t"))
        few, many = rows.where(F.col("k") <= FEW), rows.where(F.col("k") > FEW)

        with scope(docs.sparkSession) as keep_links:
            degree = many.groupBy("c").agg((F.count(F.lit(1)) / F.first("n")).alias("q"), F.count(F.lit(1)).alias("crowded"))
            degree = settle(degree)
            ranked = settle(many.join(degree, "c"))
            heads = ranked.groupBy("t").agg(F.max(F.struct("q", "n", "c")).alias("head"))
            heads = settle(heads.select("t", F.col("head.c").alias("head"), F.col("head.n").alias("head_n")))
            stars = (
                ranked.join(heads, "t")
                .where("c != head")
                .where((F.least("n", "head_n") * 100) >= (F.greatest("n", "head_n") * percent))
                .select(F.least("c", "head").alias("a"), F.greatest("c", "head").alias("b"))
            )
            stars = stars.unionAll(settle(_meetings(few, degree, percent))).distinct()
            checked = settle_in_small_batches(bounded(settle(stars), nodes, percent), PORTION, keep_links)
            links = keep_links(_verify(checked, classes, base, words, percent))
        first = components(links) if not links.isEmpty() else None

        with scope(docs.sparkSession) as keep_more:
            held = _open(many, first)
            if first is not None:
                again = settle(_outside(held, percent).join(checked, ["a", "b"], "left_anti"))
                again = settle_in_small_batches(bounded(again, nodes, percent), PORTION)
                checked = settle(checked.unionAll(again))
                links = keep_more(links.unionAll(_verify(again, classes, base, words, percent)))
                held = _open(many, components(links))
            own = settle_in_small_batches(token_lists(held), PORTION)
            in_trees = _representatives(own, classes, base)
            wide = settle_in_small_batches(tree_parities(in_trees, words).join(own, "c", "left_semi").dropDuplicates(["c"]), PORTION)
            sigs = settle(nodes.select("c", "sig").join(wide, "c").join(own.select("c", "ts"), "c"))
            rest = tree_pairs(settle(held.join(own.select("c", "f"), "c")), sigs, percent)
            if first is not None:
                rest = settle(rest.join(checked, ["a", "b"], "left_anti"))  # those are decided
            more = keep_more(_verify(rest, classes, base, words, percent))
        both = links.unionAll(more)
        out = classes.select("c", "id", "copies").withColumn("root", F.col("c"))
        if not both.isEmpty():
            final = settle(components(both))
            out = classes.join(final.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        out = settle(out)
        roots = settle(out.groupBy("root").agg(F.min("id").alias("component_id")))
        named = keep(out.join(roots, "root").select("c", "component_id"))
    single = keys.where("c is null").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    joined = keys.where("c is not null").join(named, "c").select("id", F.col("n").alias("n_shingles"), "component_id")
    return joined.unionAll(single).withColumnRenamed("id", id_col)


def _open(many: DataFrame, found: DataFrame | None) -> DataFrame:
    """(t, c, n, comp) of tokens whose classes are of several components; ``found``: (node, root) of the links so far."""
    with_comp = many.withColumn("comp", F.col("c"))
    if found is not None:
        roots = settle(found.select(F.col("node").alias("c"), "root"))
        with_comp = many.join(roots, "c", "left").withColumn("comp", F.coalesce("root", "c")).drop("root")
    with_comp = settle(with_comp)
    open_ = with_comp.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("t")
    return settle(with_comp.join(settle(open_), "t").select("t", "c", "n", "comp"))


def _outside(held: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a class and one of the largest component under a token, if the class is of another; a pair a row at most."""
    sizes = held.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("k"))
    largest = settle(sizes.groupBy("t").agg(F.max(F.struct("k", "comp"))["comp"].alias("main")))
    inside = settle(held.join(largest, "t"))
    drawn = F.max(F.struct(F.xxhash64("t", "c").alias("by"), "c", "n")).alias("head")
    heads = settle(inside.where("comp = main").groupBy("t").agg(drawn).select("t", F.col("head.c").alias("head"), F.col("head.n").alias("head_n")))
    return (
        inside.where("comp != main")
        .join(heads, "t")
        .where((F.least("n", "head_n") * 100) >= (F.greatest("n", "head_n") * percent))
        .select(F.least("c", "head").alias("a"), F.greatest("c", "head").alias("b"))
        .distinct()
    )


def _meetings(few: DataFrame, degree: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that meet under tokens of at most ``FEW`` classes and whose leading tokens admit a link.

    Of two sets, the one whose leading tokens end first has all common tokens among the leading ones of both, or behind
    its own. So their overlap is at most the tokens that both have in front and the larger of the two rests; what they
    share under crowded tokens is at most the smaller number of those.
    """
    left = few.select("t", F.col("c").alias("a"), F.col("n").alias("na"))
    right = few.select("t", F.col("c").alias("b"), F.col("n").alias("nb"))
    met = (
        left.join(right, "t")
        .where("a < b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    )
    for side in "ab":
        met = met.join(degree.select(F.col("c").alias(side), F.col("crowded").alias(f"crowded_{side}")), side, "left")
    crowded = F.least(*[F.coalesce(f"crowded_{side}", F.lit(0)) for side in "ab"])
    need = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    behind = F.greatest(*[F.expr(f"({percent} * n{side} + 99) div 100 - 1") for side in "ab"])
    return met.where(F.col("shared") + crowded >= need - behind).select("a", "b")


def _representatives(wanted: DataFrame, classes: DataFrame, base: DataFrame) -> DataFrame:
    """Rows of ``base`` that stand for the classes c of the written table ``wanted``, and some others that the filter lets through."""
    ids = settle(classes.join(wanted.select("c"), "c").select(F.xxhash64("id").alias("k")))
    return only(base.withColumn("k", F.xxhash64("id")), "k", ids)


def _verify(pairs: DataFrame, classes: DataFrame, base: DataFrame, words: int, percent: int) -> DataFrame:
    """Exact decision of pairs of classes; their sets are made again from the texts of their representatives alone."""
    ends = settle(pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct())
    sets = settle_in_small_batches(token_sets(_representatives(ends, classes, base), words).join(ends, "c", "left_semi").dropDuplicates(["c"]), PORTION)
    left = sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    union = F.size("ta") + F.size("tb") - F.col("common")
    return both.where(F.col("common") * 100 >= union * percent).select("a", "b")
