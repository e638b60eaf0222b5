"""Near-duplicate documents by weighted Jaccard similarity of word shingles.

Signatures are bag minwise hashes. Every shingle owns a Poisson process over time and
weight; the weights are discretised to whole numbers and the process is a hierarchy
of halved weight ranges, each known by its first point. Ranges beyond a shingle's
count, and ranges whose first point is too late to matter, are dropped unsplit. Every
point falls into one of ``SIZE`` registers, and a register keeps its earliest point:
two documents agree in a register with a probability of exactly their similarity.

Documents with the same shingles collapse first. Bands of registers make buckets.
In a bucket, members are compared with one leader by signature; only buckets with
members unlike their leader are looked at again, those members against all others,
in blocks. What the signatures can't rule out forms candidate groups. In each group,
in bounded blocks, true multiset overlaps decide the links, and the components of
the links are the classes.

With 32 bands of 6 registers, a pair at a similarity of exactly 0.8 shares no bucket
with a probability of 6e-5, and a shared bucket's signatures fail it with less than
1e-5; both fall steeply above it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import cut, grouped, list_array, quoted, ranges, slices, text_buffer
from quartermill.llm.components import connected_components

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SIZE = 256
BANDS, ROWS = 32, 6
#: Registers that agree at a similarity of 0.8, less 4.5 standard deviations.
LEAST_EQUAL = 176
BLOCK = 2048
SHINGLES_PER_BLOCK = 1 << 21
BROADCAST_ROWS = 1 << 18
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of all runs of ``width`` words, repeats included.

    A text of fewer words, but not none, is one shingle.
    """
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(h))):
        out = (out + h[k : k + n]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k)
    out = mix(out)
    out.sort()
    return out


def occurrence(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted values per document: which repeat each is (from 0), and where runs start."""
    n = len(flat)
    new = np.ones(n, bool)
    new[1:] = flat[1:] != flat[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(new)
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n))), starts


def exponential(bits: np.ndarray) -> np.ndarray:
    """Exponential variates of rate one from the upper bits."""
    return -np.log(((bits >> np.uint64(12)).astype(np.float64) + 1.0) * 2.0**-52)


def processes(flat: np.ndarray, bounds: np.ndarray, horizon: np.ndarray, size: int):
    """Leaves (document, seed, first point) of all shingle processes up to each document's horizon.

    The weight ranges at the top are [0, 1), [1, 2), [2, 4), [4, 8) and so on. The
    first point of a range belongs to one half of it; the other half's first point
    follows after a wait of its own. All depends on the shingle and the range alone.
    """
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, starts = occurrence(flat, bounds)
    weight = np.diff(np.append(starts, len(flat)))
    docs, seeds = doc[starts], flat[starts]
    leaves = [(docs, mix(seeds + GOLDEN), None)]
    low = 1
    many = np.flatnonzero(weight > 1)
    while len(many):
        width = max(1, low)
        rate = size * float(width)
        seed = mix(seeds[many] + GOLDEN * np.array([2 * low + 1], np.uint64))
        node = [docs[many], seeds[many], np.full(len(many), low), np.full(len(many), width), exponential(seed) / rate, weight[many]]
        while len(node[0]):
            keep = (node[4] <= horizon[node[0]]) & (node[2] < node[5])
            node = [x[keep] for x in node]
            leaf = node[3] == 1
            if leaf.any():
                d, h, at, _, x, _ = (v[leaf] for v in node)
                leaves.append((d, mix(h + GOLDEN * (np.uint64(2) * at.astype(np.uint64) + np.uint64(1))), x))
            d, h, at, width_, x, w = (v[~leaf] for v in node)
            if not len(d):
                break
            half = width_ // 2
            draw = mix(mix(h + np.uint64(3) * at.astype(np.uint64)) + GOLDEN * width_.astype(np.uint64))
            right = (draw & np.uint64(1)).astype(bool)
            later = x + exponential(mix(draw + GOLDEN)) / (size * half)
            node = [np.concatenate(p) for p in (
                (d, d), (h, h), (at, at + half), (half, half), (np.where(right, later, x), np.where(right, x, later)), (w, w))]
        low *= 2
        many = many[weight[many] > low]
    return leaves


def earliest(flat: np.ndarray, bounds: np.ndarray, horizon: np.ndarray, size: int, at_once: int) -> np.ndarray:
    """Earliest point of every register up to each document's horizon.

    Points are summed strictly one after another, from the first on, so ``at_once`` changes no bit of them.
    """
    registers = np.full((len(bounds) - 1) * size, np.inf)
    for docs, seeds, first in processes(flat, bounds, horizon, size):
        x = exponential(seeds) / size if first is None else first
        points, bits, step = x[:, None], seeds[:, None], 1
        while len(docs):
            ok = points <= horizon[docs][:, None]
            register = docs[:, None] * size + (bits & np.uint64(0xFFF)).astype(np.int64) % size
            np.minimum.at(registers, register[ok], points[ok])
            more = ok[:, -1]
            docs, seeds, x = docs[more], seeds[more], points[more, -1]
            bits = mix(seeds[:, None] + GOLDEN * np.arange(step, step + at_once, dtype=np.uint64))
            points = np.cumsum(np.concatenate([x[:, None], exponential(bits) / size], axis=1), axis=1)[:, 1:]
            step += at_once
    return registers.reshape(-1, size)


def signatures(flat: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Earliest point of every register, per document (float64; ``inf`` for a document without shingles)."""
    counts = np.diff(bounds)
    out = np.full((len(counts), size), np.inf)
    todo, reach = np.flatnonzero(counts > 0), 13.0
    while len(todo):
        # Short documents have many points per shingle, long ones few: draw accordingly many at once.
        short = counts[todo] < 100
        for chosen, at_once in ((todo[short], 64), (todo[~short], 4)):
            for a, b in slices(np.concatenate([[0], np.cumsum(counts[chosen])]), (1 << 20) // at_once):
                own = chosen[a:b]
                inner = np.concatenate([[0], np.cumsum(counts[own])])
                out[own] = earliest(flat[ranges(bounds[own], counts[own])], inner, reach / counts[own], size, at_once)
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        reach *= 2
    return out


def bands(points: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band."""
    bits = points[:, : BANDS * ROWS].view(np.uint64).reshape(len(points), BANDS, ROWS)
    key = np.zeros((len(points), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * GOLDEN + bits[:, :, k])
    return key.view(np.int64)


def sign(docs: DataFrame, doc: str, text: str, width: int) -> DataFrame:
    """Per row: ``doc``, ``h`` (hash of the text), ``key`` (of its shingles; null without words), ``n``, ``sig``, ``bands``."""

    def run(batches):
        for batch in batches:
            data, offsets, _ = text_buffer(batch.column(2))
            for a, b in slices(offsets, 2 << 20):
                raw, at = data[offsets[a] : offsets[b]].tobytes(), (offsets[a : b + 1] - offsets[a]).tolist()
                own = [shingles(raw[x:y], width) for x, y in zip(at, at[1:])]
                counts = np.array([len(s) for s in own], np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                points = signatures(np.concatenate(own), bounds)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in own]
                low = mix(points.view(np.uint64)).astype(np.uint8)
                some = counts > 0
                lengths = np.where(some, BANDS, 0)
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(a, b - a) for c in batch.columns[:2]], pa.array(keys, pa.binary()), pa.array(counts),
                    pa.array([r.tobytes() for r in low], pa.binary()), list_array(pa.array(bands(points)[some].ravel()), lengths),
                ], names=["doc", "h", "key", "n", "sig", "bands"])

    rows = docs.select(F.col(quoted(doc)).cast("long").alias("doc"), F.xxhash64(quoted(text)).alias("h"), F.col(quoted(text)))
    return rows.mapInArrow(run, "doc long, h long, key binary, n long, sig binary, bands array<long>")


def register_bytes(column: pa.Array) -> np.ndarray:
    """Signatures as one row of bytes each."""
    return text_buffer(column)[0].reshape(len(column), SIZE)


def alike(pairs: DataFrame) -> DataFrame:
    """Pairs whose signatures (``sig_a``, ``sig_b``) agree often enough."""

    def run(batches):
        for batch in batches:
            a, b = (register_bytes(batch.column(k)) for k in (2, 3))
            ok = (a == b).sum(axis=1) >= LEAST_EQUAL
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def forest(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all members alike in signature, at most one per member.

    Rows of side 1 are compared with all rows of sides 0 and 2; those of side 2 are
    known to be connected with one another.
    """
    side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
    sig = register_bytes(table.column("sig").combine_chunks())
    ids, where = np.unique(node, return_inverse=True)
    label = np.arange(len(ids))
    label[where[side == 2]] = len(ids)
    others = np.flatnonzero(side != 1)
    left, right = [], []
    for k in np.flatnonzero(side == 1):
        mine = label[where[k]]
        far = others[label[where[others]] != mine]
        far = far[(sig[far] == sig[k]).sum(axis=1) >= LEAST_EQUAL]
        if len(far):
            found, first = np.unique(label[where[far]], return_index=True)
            left += [node[k]] * len(found)
            right += node[far[first]].tolist()
            label[np.isin(label, found)] = mine
    return np.array(left, np.int64), np.array(right, np.int64)


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` that connect all documents which share a bucket and are alike in signature."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.count("node").alias("n"), F.min("node").alias("leader")).filter("n > 1")
    members = cut(rows.join(buckets, "band"))
    sigs = nodes.select("node", "sig")
    pairs = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = cut(alike(
        pairs.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        .join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")))
    led = stars.select(F.col("a").alias("leader"), F.col("b").alias("node"), F.lit(2).alias("led"))
    told = members.join(led, ["leader", "node"], "left").select(
        "band", "node", "n", F.when(F.col("node") == F.col("leader"), 2).otherwise(F.coalesce("led", F.lit(0))).alias("side"))
    odd = told.filter("side = 0").groupBy("band").agg(F.count("node").alias("odd"))
    told = cut(told.join(odd, "band")).join(sigs, "node")
    block = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    deal = lambda n: F.pmod(F.xxhash64("node"), block(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), block(n) - 1))
    every = told.select("band", "node", "sig", "side", upto("odd").alias("i"), deal("n").alias("j"))
    few = told.filter("side = 0").select("band", "node", "sig", F.lit(1).alias("side"), deal("odd").alias("i"), upto("n").alias("j"))
    found = grouped(every.unionByName(few), ["band", "i", "j"], forest, "a long, b long")
    return stars.union(found)


def true_links(own: list[np.ndarray], similarity: tuple[int, int]) -> tuple[list[int], list[int]]:
    """Links that connect all documents of a block whose multisets overlap enough.

    Each document is compared, once, with those not yet reached, through lists of the
    documents of each shingle. ``similarity`` is a fraction, so no rounding decides.
    """
    top, bottom = similarity
    sizes = np.array([len(s) for s in own], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(own)
    nth, _ = occurrence(flat, bounds)
    _, token = np.unique(mix(flat + GOLDEN * nth.astype(np.uint64)), return_inverse=True)
    doc = np.repeat(np.arange(len(own)), sizes)
    order = np.argsort(token, kind="stable")
    posts, holders = token[order], doc[order]
    start = np.searchsorted(posts, np.arange(token.max() + 2 if len(token) else 1))
    unseen, left, indexed = np.ones(len(own), bool), len(own), len(own)
    a, b = [], []
    for seed in range(len(own)):
        if not unseen[seed]:
            continue
        unseen[seed], left, queue = False, left - 1, [seed]
        while queue and left:
            if left < indexed // 2:
                keep = unseen[holders]
                posts, holders, indexed = posts[keep], holders[keep], left
                start = np.searchsorted(posts, np.arange(len(start)))
            d = queue.pop()
            mine = token[bounds[d] : bounds[d + 1]]
            found = holders[ranges(start[mine], start[mine + 1] - start[mine])]
            common = np.bincount(found, minlength=len(own))
            near = np.flatnonzero(unseen & (common > 0))
            common = common[near]
            near = near[bottom * common >= top * (sizes[d] + sizes[near] - common)]
            unseen[near] = False
            left -= len(near)
            a += [d] * len(near)
            b += near.tolist()
            queue += near.tolist()
    return a, b


def leader_links(own: list[np.ndarray], leader: int, similarity: tuple[int, int]) -> np.ndarray:
    """Which documents of a block overlap enough with its leader."""
    top, bottom = similarity
    sizes = np.array([len(x) for x in own], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(own)
    nth, _ = occurrence(flat, bounds)
    token = mix(flat + GOLDEN * nth.astype(np.uint64))
    shared = np.concatenate([[0], np.cumsum(np.isin(token, token[bounds[leader] : bounds[leader + 1]]))])
    common = shared[bounds[1:]] - shared[bounds[:-1]]
    near = (common > 0) & (bottom * common >= top * (sizes + sizes[leader] - common))
    near[leader] = False
    return np.flatnonzero(near)


def verify(docs: DataFrame, nodes: DataFrame, groups: DataFrame, doc: str, text: str, width: int, similarity, block: int) -> DataFrame:
    """True links ``a``, ``b`` inside the candidate groups (``node``, ``label``).

    A group of one block is solved whole. In a larger one every member meets its leader
    first, a text going out once; only members unlike the leader then meet all others,
    each text going out once per block of such members.
    """
    sized = groups.join(nodes.select("node", "rep", "n"), "node")
    blocks = sized.groupBy("label").agg(F.ceil(F.sum("n") / block).cast("long").alias("blocks"), F.min("node").alias("leader"))
    wanted = cut(sized.join(blocks, "label").select(
        "label", "node", "n", "blocks", "leader", F.col("rep.doc").alias("doc"), F.col("rep.h").alias("h"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")))
    texts = docs.select(F.col(quoted(doc)).cast("long").alias("__doc"), F.col(quoted(text)).alias("__text"))

    def with_texts(some: DataFrame) -> DataFrame:
        # Documents are many and wanted ones few: send those to every task while they are, or else meet by id.
        few = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
        return texts.join(few, F.col("__doc").eqNullSafe(F.col("doc")) & (F.xxhash64("__text") == F.col("h")))

    def solve(table):
        node, lead = table.column("node").to_numpy(), table.column("lead").to_numpy()
        data, offsets, _ = text_buffer(table.column("__text").combine_chunks())
        raw, at = data.tobytes(), offsets.tolist()
        ids, first = np.unique(node, return_index=True)
        own = [shingles(raw[at[k] : at[k + 1]], width) for k in first]
        if lead.any():
            leader = int(np.flatnonzero(lead[first])[0])
            near = leader_links(own, leader, similarity)
            return np.full(len(near), ids[leader]), ids[near]
        a, b = true_links(own, similarity)
        return ids[a] if a else np.zeros(0, np.int64), ids[b] if b else np.zeros(0, np.int64)

    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    unit = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    is_leader = F.col("node") == F.col("leader")
    large = F.col("blocks") > 1
    first = F.when(large & is_leader, F.transform(upto(F.col("blocks")), lambda i: unit(i, F.lit(-1)))).when(
        large, F.array(unit(F.col("own"), F.lit(-1)))).otherwise(F.array(unit(F.lit(0), F.lit(0))))
    keys = ["label", "i", "j"]
    rows = with_texts(wanted).select("label", "node", "__text", (large & is_leader).alias("lead"), F.inline(first))
    links = cut(grouped(rows, keys, solve, "a long, b long"))
    led = links.select(F.col("a").alias("leader"), F.col("b").alias("node"))
    odd = cut(wanted.filter(large & ~is_leader).join(led, ["leader", "node"], "left_anti"))
    if odd.isEmpty():
        return links
    few = odd.groupBy("label").agg(F.ceil(F.sum("n") / block).cast("long").alias("odd_blocks"))
    again = cut(wanted.join(few, "label").join(odd.select("label", "node", F.lit(True).alias("odd")), ["label", "node"], "left"))
    mine = F.pmod(F.xxhash64("node"), F.col("odd_blocks"))
    every = F.transform(upto(F.col("odd_blocks")), lambda i: unit(i, F.col("own")))
    own = F.when(F.col("odd"), F.transform(upto(F.col("blocks")), lambda j: unit(mine, j))).otherwise(F.array().cast("array<struct<i:bigint,j:bigint>>"))
    rest = with_texts(again).select("label", "node", "__text", F.lit(False).alias("lead"), F.inline(F.array_distinct(F.concat(every, own))))
    return links.union(grouped(rest, keys, solve, "a long, b long"))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 5, similarity: tuple[int, int] = (4, 5),
                    block: int = SHINGLES_PER_BLOCK) -> DataFrame:
    """The class of every row: ``doc``, ``h`` (hash of its text), ``class_id``, ``keeper``.

    Words are lower-cased runs of ASCII letters, digits and any other characters
    outside ASCII. Two documents are linked if the multisets of their ``width``-word
    shingles have a weighted Jaccard similarity of at least ``similarity`` (a
    fraction). Classes are the components of the links; ``class_id`` is the least
    document id in the class, and ``keeper`` marks the row with the least id (and
    text hash) of it. A text of fewer words is one shingle of all of them. A null text,
    and one without words, is in a class of its own. Rows that repeat id and text are
    in one class and are all marked if one is; rows with the same id but other texts
    are apart. A null id gives way to any other as ``class_id``. Empty tables give no rows.
    """
    rows = cut(sign(docs, doc, text, width))
    nodes = cut(
        rows.filter("key IS NOT NULL").groupBy("key")
        .agg(F.min(F.struct(F.isnull("doc").alias("none"), "doc", "h")).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()))
    groups = connected_components(candidates(nodes))
    classes = connected_components(verify(docs, nodes, groups, doc, text, width, similarity, block))
    named = classes.join(nodes.select("node", "rep"), "node")
    least = named.groupBy("label").agg(F.min("rep").alias("least"))
    least = named.join(least, "label").select("node", "least")
    final = nodes.select("key", "node", "rep").join(least, "node", "left").select("key", F.coalesce("least", "rep").alias("least"))
    return rows.select("doc", "h", "key").join(final, "key", "left").select(
        "doc", "h", F.when(F.col("key").isNull(), F.col("doc")).otherwise(F.col("least.doc")).alias("class_id"),
        (F.col("key").isNull() | (F.col("doc").eqNullSafe(F.col("least.doc")) & (F.col("h") == F.col("least.h")))).alias("keeper"))


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, one row of each class; see :func:`near_duplicates`.

    Rows that repeat id and text count as copies (null and word-free texts too).
    """
    rows = cut(near_duplicates(docs, doc, text, **options))
    marked = rows.groupBy("doc", "h").agg(F.count(F.lit(1)).alias("times"), F.first("keeper").alias("keeper"))
    odd = cut(marked.filter("NOT keeper OR times > 1"))
    few = F.broadcast(odd) if odd.count() <= BROADCAST_ROWS else odd
    same = F.col(quoted(doc)).cast("long").eqNullSafe(F.col("__odd.doc")) & (F.xxhash64(quoted(text)) == F.col("__odd.h"))
    kept = docs.join(few.alias("__odd"), same, "left_anti")
    again = odd.filter("keeper")
    if again.isEmpty():
        return kept
    once = docs.join(again.alias("__odd"), same, "left_semi").dropDuplicates([doc, text])
    return kept.unionByName(once)
