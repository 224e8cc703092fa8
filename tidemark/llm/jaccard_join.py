"""Exact n-gram Jaccard self-join and its groups.

A document's set holds the 64-bit hashes of its distinct word n-grams; "exact" below is up to these
hashes. Documents with one and the same set are one entity, known by a 64-bit sum signature to the
end, so copies are never paired and one id on several texts is several entities. An entity's text is
read from the rows of its smallest id.

1. Candidates. All n-grams get one global order: those seen often go last. With similarity t, two
   linked sets share an n-gram among the first n - ceil(t n) + 1 of each (the prefix), so an
   inverted index over prefixes loses no link. The order's table of frequent n-grams has a fixed
   size (FREQUENT); it decides how many candidates arise, never which links are found. Entries
   travel as packed arrays per bucket of n-grams. An n-gram with more than HOT holders is dealt out
   as tiles: by size band (two linked sizes lie in one band or in neighbours), then by pairs of
   salts.
2. In a bucket, holders of an n-gram stand sorted by size. Up to SMALL of them give all pairs of
   compatible size; longer lists are kept as lists.
3. Each pair first meets as bitmaps of hashed n-grams (width by size, two widths folded to the
   smaller). Bits set on one side only are elements that the other lacks, so bit counts bound the
   overlap from above. A long list is one tile: the pairs that the bound leaves there are spanned
   by a forest, of which alone the edges go on. Pairs and forests split the entities into candidate
   groups: no link leaves one.
4. A candidate group of up to GROUP_GRAMS n-grams is one task's tile: its texts come together,
   pairs are settled by intersecting the sorted arrays, and where a long list took part all pairs
   of compatible size between different components pass the bound and the intersection too. Pairs
   inside a component could not change it.
5. Larger candidate groups go by joins: pairs meet the arrays of both sides, components form, and
   the long lists that still span several components give their pairs, block by block of a list.
   A document's component is the smallest id in it.

Null and empty texts: empty set, linked with nothing. Fewer words than n: the whole sequence is
one n-gram. Repeated rows come back as often as they came. One id on several texts: each row has its
own text's component. A row without an id has the component of the rows with its set, else none, and
links nothing. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import components, drop, store
from .textkit import LOWER, buffers, chunks, cut, documents, gram_hashes, mix, narrow, word_hashes

WORDS = 5
SIMILARITY = (75, 100)
FREQUENT = 1 << 18
LOCAL_REPEATS = 8
SMALL = 16
HOT = 50_000
BUCKET_ENTRIES = 500_000
FLUSH_ENTRIES = 1_000_000
GROUP_GRAMS = 4_000_000


def document_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each document."""
    hashes, first = word_hashes(LOWER[data], offsets)
    grams = gram_hashes(hashes, words)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            g = np.sort(grams[a : b - words + 1])
            keep = np.ones(len(g), dtype=bool)
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            out.append(g[keep])
        elif b > a:
            out.append(mix(gram_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(grams: np.ndarray) -> int:
    return int(mix(grams ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).view(np.int64))


def batch_sets(column: pa.Array, words: int = WORDS):
    """(first document of a chunk, its sets) for a column of texts."""
    data, offsets = buffers(column)
    for first, _, part, at in chunks(data, offsets):
        yield first, document_sets(part, at, words)


def prefix_length(n: int, similarity=SIMILARITY) -> int:
    need = -(-similarity[0] * n // similarity[1])
    return n - need + 1


def size_band(n: int, similarity=SIMILARITY) -> int:
    return int(math.log(n) / math.log(similarity[1] / similarity[0]) + 1e-9)


def bitmap(grams: np.ndarray) -> np.ndarray:
    width = 64
    while width < 2 * len(grams) and width < 1 << 16:
        width *= 2
    bits = np.zeros(width, dtype=bool)
    bits[(mix(grams) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def fold(words: np.ndarray, to: int) -> np.ndarray:
    return words if len(words) == to else np.bitwise_or.reduce(words.reshape(-1, to), axis=0)


def enough(overlap, na, nb, similarity=SIMILARITY):
    """Whether this overlap makes a link: overlap / union >= similarity."""
    s, t = similarity
    return t * overlap >= s * (na + nb - overlap)


def overlap_bound(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> int:
    w = min(len(a), len(b))
    a, b = fold(a, w), fold(b, w)
    return min(na - int(np.bitwise_count(a & ~b).sum()), nb - int(np.bitwise_count(b & ~a).sum()))


SCAN = ["kind", "id", "t", "n", "s", "bits"]


def scan_sets(docs: DataFrame, words: int) -> DataFrame:
    """Kind 0: id, text hash, size, signature and bitmap of each row. Kind 1: n-grams repeated within one run of texts."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        held, size, seen = [], 0, set()

        def repeated():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= LOCAL_REPEATS
            return values[often], counts[often]

        for batch in batches:
            ids, n, s, bits = batch.column(0), [], [], []
            for _, sets in batch_sets(batch.column(1), words):
                for grams in sets:
                    n.append(len(grams))
                    s.append(signature(grams) if len(grams) else 0)
                    bits.append(bitmap(grams).tobytes() if len(grams) else None)
                    if len(grams) and (s[-1], n[-1]) not in seen:
                        seen.add((s[-1], n[-1]))
                        held.append(grams)
                        size += len(grams)
                if size >= 2 * FLUSH_ENTRIES:
                    yield pair_rows(ids.type, *repeated())
                    held, size, seen = [], 0, set()
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), ids, batch.column(2), pa.array(n, pa.int64()), pa.array(s, pa.int64()), pa.array(bits, pa.binary())], names=SCAN)
        if held:
            yield pair_rows(ids.type, *repeated())

    def pair_rows(id_kind, values, counts):
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(values), np.int32)), pa.nulls(len(values), id_kind), pa.nulls(len(values), pa.int64()), pa.array(counts.astype(np.int64)), pa.array(values.view(np.int64)), pa.nulls(len(values), pa.binary())], names=SCAN)

    return docs.select("id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, f"kind int, id {id_type}, t long, n long, s long, bits binary")


def frequent_grams(scanned: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """At most `limit` n-grams (sorted) with their counts; used for the order of n-grams alone."""
    top = scanned.where("kind = 1").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(limit).toArrow()
    grams = top.column("s").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], top.column("n").to_numpy()[order]


def tile_keys(gram: int, holders: int, n: int, s: int, hot: int, similarity) -> list[int]:
    """Keys of the tiles that a holder of a hot n-gram goes to: its size bands, then pairs of salts."""
    salts = -(-holders // hot)
    salt = (s >> 7) % salts
    band = size_band(n, similarity)
    raw = [(gram + (g * salts + min(salt, j)) * salts + max(salt, j)) % (1 << 64) for g in (band, band + 1) for j in range(salts)]
    return mix(np.asarray(raw, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)).tolist()


def prefix_entries(docs: DataFrame, frequent, buckets: int, words: int, similarity, hot: int) -> DataFrame:
    """Packed index entries: per bucket of n-grams the holders' signatures, sizes and prefix n-grams."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent)  # FREQUENT rows at most

    def flush(grams, owner, s, n):
        grams, owner = np.concatenate(grams), np.concatenate(owner)
        s, n = np.asarray(s, dtype=np.int64), np.asarray(n, dtype=np.int32)
        bucket = ((grams >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, grams, owner = bucket[order], grams[order], owner[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = owner[a:b]
            new = np.flatnonzero(np.diff(own, prepend=-1))
            who = own[new]
            rows.append((int(bucket[a]), s[who].tobytes(), n[who].tobytes(), np.diff(new, append=len(own)).astype(np.int32).tobytes(), grams[a:b].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names=["bucket", "s", "n", "held", "grams"])

    def run(batches):
        common, counts = shared.value
        rank = np.empty(len(common), dtype=np.uint64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(common), dtype=np.uint64) + np.uint64(1 << 63)
        grams, owner, s, n, size, seen = [], [], [], [], 0, set()
        for batch in batches:
            for _, sets in batch_sets(batch.column(1), words):
                for own in sets:
                    if not len(own) or (key := (signature(own), len(own))) in seen:
                        continue
                    seen.add(key)
                    chosen = prefix_of(own, common, rank, similarity)
                    if hot_at := hot_ones(chosen, common, counts, hot):
                        tiles = [k for g, c in hot_at for k in tile_keys(g, c, key[1], key[0], hot, similarity)]
                        chosen = np.concatenate([chosen[~np.isin(chosen, np.asarray([g for g, _ in hot_at], dtype=np.uint64))], np.asarray(tiles, dtype=np.uint64)])
                    grams.append(chosen)
                    owner.append(np.full(len(chosen), len(s), dtype=np.int64))
                    s.append(key[0])
                    n.append(key[1])
                    size += len(chosen)
                if size >= FLUSH_ENTRIES:
                    yield flush(grams, owner, s, n)
                    grams, owner, s, n, size, seen = [], [], [], [], 0, set()
        if size:
            yield flush(grams, owner, s, n)

    return docs.mapInArrow(run, "bucket int, s binary, n binary, held binary, grams binary")


def at_of(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Positions in `common`, or -1."""
    if not len(common):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
    return np.where(common[at] == values, at, -1)


def prefix_of(own: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity) -> np.ndarray:
    p = prefix_length(len(own), similarity)
    at = at_of(own, common)
    rare = own[at < 0]
    if len(rare) >= p:
        return rare[:p]
    often = own[at >= 0]
    order = np.argsort(rank[at[at >= 0]], kind="stable")
    return np.concatenate([rare, often[order[: p - len(rare)]]])


def hot_ones(chosen: np.ndarray, common: np.ndarray, counts: np.ndarray, hot: int) -> list[tuple[int, int]]:
    at = at_of(chosen, common)
    hits = np.flatnonzero((at >= 0) & (counts[at] > hot)) if len(counts) else []
    return [(int(chosen[i]), int(counts[at[i]])) for i in hits]


def bucket_candidates(similarity, small: int = SMALL):
    """Function of one bucket: candidate pairs (kind 0) and long lists of holders (kind 1)."""
    names = ["kind", "sa", "na", "sb", "nb", "list_id", "members"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    lo, hi = similarity

    def run(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)

        t, held = joined("grams", np.uint64), joined("held", np.int32)
        s, n = np.repeat(joined("s", np.int64), held), np.repeat(joined("n", np.int32), held)
        order = np.argsort(t, kind="stable")
        ts = t[order]
        same = ts[1:] == ts[:-1]
        twice = np.zeros(len(ts), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        order = order[twice]
        t, s, n = t[order], s[order], n[order].astype(np.int64)
        order = np.lexsort((s, n, t))
        t, s, n = t[order], s[order], n[order]
        keep = np.ones(len(t), dtype=bool)
        keep[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1]) | (n[1:] != n[:-1])
        t, s, n = t[keep], s[keep], n[keep]
        edges = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(edges, len(t)))
        length = np.repeat(sizes, sizes)
        left, right = [], []
        for k in range(1, small):
            i = np.flatnonzero((length[k:] <= small) & (t[k:] == t[:-k]) & (hi * n[:-k] >= lo * n[k:])) if len(t) > k else np.zeros(0, np.int64)
            left.append(i)
            right.append(i + k)
        lists = {}
        for a, m in zip(edges[sizes > small].tolist(), sizes[sizes > small].tolist()):
            who = np.stack([s[a : a + m], n[a : a + m]], axis=1)
            list_id = int((mix(who[:, 0].view(np.uint64)) + mix(who[:, 1].view(np.uint64) + np.uint64(77))).sum(dtype=np.uint64).view(np.int64))
            lists[list_id] = who.tobytes()
        i, j = np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)
        pairs = np.unique(np.stack([s[i], n[i], s[j], n[j]], axis=1), axis=0) if len(i) else np.zeros((0, 4), np.int64)
        p, q = len(pairs), len(lists)
        columns = [np.concatenate([np.zeros(p), np.ones(q)]).astype(np.int32), *(np.concatenate([pairs[:, c], np.zeros(q, np.int64)]) for c in range(4)), np.concatenate([np.zeros(p, np.int64), np.asarray(list(lists), dtype=np.int64)])]
        arrays = [*(pa.array(x, y) for x, y in zip(columns, types)), pa.array([None] * p + list(lists.values()), pa.binary())]
        return pa.table(arrays, names=names)

    return run, "kind int, sa long, na long, sb long, nb long, list_id long, members binary"


def long_lists(found: DataFrame) -> DataFrame:
    """list_id, s, n: the holders of each distinct long list."""

    def unpack(batches):
        for batch in batches:
            for list_id, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                who = np.frombuffer(blob, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), list_id)), pa.array(who[:, 0]), pa.array(who[:, 1])], names=["list_id", "s", "n"])

    return found.where("kind = 1").select("list_id", "members").dropDuplicates(["list_id"]).mapInArrow(unpack, "list_id long, s long, n long")


def entity_arrays(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """s, n, grams of the entities in `wanted` (rep, s, n), from the texts of their smallest id."""

    def run(batches):
        for batch in batches:
            s, n = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for first, sets in batch_sets(batch.column(0), words):
                hit = [(first + k, g) for k, g in enumerate(sets) if len(g) == n[first + k] and signature(g) == s[first + k]]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array([k for k, _ in hit], pa.int64())), pa.array([len(g) for _, g in hit], pa.int64()), pa.array([g.tobytes() for _, g in hit], pa.binary())], names=["s", "n", "grams"])

    texts = docs.join(wanted, docs["id"] == wanted["rep"]).select("text", "s", "n")
    return texts.mapInArrow(run, "s long, n long, grams binary").dropDuplicates(["s"])


def surviving(pairs: DataFrame, column: str, test) -> DataFrame:
    """a, b of the pairs whose two `column` values pass test(blob_a, n_a, blob_b, n_b)."""

    def run(batches):
        for batch in batches:
            blobs = [[np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(c)] for c in (2, 4)]
            sizes = [batch.column(c).to_pylist() for c in (3, 5)]
            ok = [test(a, na, b, nb) for a, na, b, nb in zip(blobs[0], sizes[0], blobs[1], sizes[1])]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", f"{column}_a", "n_a", f"{column}_b", "n_b").mapInArrow(run, "a long, b long")


def with_sides(pairs: DataFrame, entities: DataFrame, column: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(entities.select(F.col("s").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"{column}_{side}")), side)
    return pairs


def bounded(pairs: DataFrame, entities: DataFrame, similarity) -> DataFrame:
    """The pairs (a, b) that the bitmap bound lets through."""
    return surviving(with_sides(pairs.select("a", "b"), entities, "bits"), "bits", lambda a, na, b, nb: enough(overlap_bound(a, na, b, nb), na, nb, similarity))


def linked(a: np.ndarray, b: np.ndarray, similarity) -> bool:
    return bool(enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), similarity))


def verified(pairs: DataFrame, entities: DataFrame, similarity) -> DataFrame:
    """The pairs (a, b) whose sorted arrays make a link."""
    return surviving(with_sides(pairs.select("a", "b"), entities, "grams"), "grams", lambda a, na, b, nb: linked(a, b, similarity))


def settle_group(ids: list, sets: list[np.ndarray], partners: list, star: bool, similarity) -> np.ndarray:
    """Component number of each entity of one candidate group."""
    order = sorted(range(len(ids)), key=lambda i: len(sets[i]))
    place = {ids[i]: k for k, i in enumerate(order)}
    sets = [sets[i] for i in order]
    label = np.arange(len(ids))
    inside = {k: [k] for k in range(len(ids))}

    def meet(i, j):
        if label[i] != label[j] and linked(sets[i], sets[j], similarity):
            more, less = sorted((int(label[i]), int(label[j])), key=lambda k: -len(inside[k]))
            label[inside[less]] = more  # the smaller side moves
            inside[more] += inside.pop(less)

    for k, i in enumerate(order):
        for other in partners[i] or ():
            meet(k, place[other])
    if star and (label != label[0]).any():
        tile = Tile(np.asarray([len(x) for x in sets]), [bitmap(x) for x in sets], similarity)
        for i in range(len(sets)):
            for k in tile.later(i, label).tolist():
                meet(i, k)
    out = np.empty(len(ids), dtype=np.int64)
    out[order] = label
    return out


def settle_groups(docs: DataFrame, members: DataFrame, words: int, similarity) -> DataFrame:
    """node, component of the entities of candidate groups of bounded size."""

    def run(batches):
        held: list[tuple] = []

        def settled(rows):
            ids, sets, partners, star = [], [], [], False
            for _, own, grams, others, starred in rows:
                star = star or starred
                if own not in ids[-1:]:  # rows of one id and text
                    ids.append(own)
                    sets.append(grams)
                    partners.append(others)
            label = settle_group(ids, sets, partners, star, similarity).tolist()
            first = dict(zip(reversed(label), reversed(ids)))
            return [(i, first[k]) for k, i in zip(label, ids)]

        def packed(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["node", "component"])

        for batch in batches:
            candidate, s, n, others, star = (batch.column(c).to_pylist() for c in (0, 1, 3, 4, 5))
            out = []
            for first, sets in batch_sets(batch.column(2), words):
                for k, grams in enumerate(sets, first):
                    if len(grams) != n[k] or signature(grams) != s[k]:
                        continue  # another text under the same id
                    if held and held[0][0] != candidate[k]:
                        out += settled(held)
                        held = []
                    held.append((candidate[k], s[k], grams, others[k], star[k]))
            if out:
                yield packed(out)
        if held:
            yield packed(settled(held))

    texts = docs.join(members, docs["id"] == members["rep"]).select("candidate", "s", "text", "n", "partners", "star")
    dealt = texts.repartition("candidate").sortWithinPartitions("candidate", "s")
    return dealt.mapInArrow(run, "node long, component long")


def settle_by_joins(docs: DataFrame, near: DataFrame, members: DataFrame, listed: DataFrame, described: DataFrame, words: int, similarity) -> DataFrame:
    """node, component of the entities of candidate groups of any size."""
    entities, path = store(entity_arrays(docs, members.select("rep", "s", "n"), words))
    pairs = near.select("a", "b").join(members.select(F.col("s").alias("a")), "a", "left_semi").distinct()
    links = cut(verified(pairs, entities, similarity))
    grouped = components(links)

    listed = listed.join(members.select("s"), "s", "left_semi")
    labelled = listed.join(grouped, listed["s"] == grouped["node"], "left").select("list_id", "s", F.coalesce("component", "s").alias("component"))
    split = labelled.groupBy("list_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("list_id")
    open_lists = labelled.join(split, "list_id").join(described.select("s", "n", "bits"), "s").select("list_id", "s", "n", "component", "bits")
    more = cut(open_lists.groupBy("list_id").applyInArrow(list_pairs(similarity), "a long, b long").distinct())
    links = cut(links.union(verified(more, entities, similarity)))
    drop(docs.sparkSession, path)
    grouped = components(links)
    return members.join(grouped, members["s"] == grouped["node"], "left").select(F.col("s").alias("node"), F.coalesce("component", "s").alias("component"))


class Tile:
    """Entities of one list by size, as folded bitmaps; bound-passing partners of each among the later ones."""

    def __init__(self, n: np.ndarray, bits: list[np.ndarray], similarity):
        self.n, self.bits, self.similarity = n, bits, similarity
        self.width = np.asarray([len(b) for b in bits])
        self.table: dict[int, np.ndarray] = {}

    def later(self, i: int, label: np.ndarray) -> np.ndarray:
        """Later entities (sizes ascend, and so do widths) of another label that may be linked with i."""
        n, (s, t) = self.n, self.similarity
        j = np.arange(i + 1, int(np.searchsorted(n, t * n[i] // s, side="right")))
        j = j[label[j] != label[i]]
        if not len(j):
            return j
        w = int(self.width[i])
        if w not in self.table:
            self.table.clear()
            self.table[w] = np.stack([fold(b, w) if len(b) >= w else np.zeros(w, np.uint64) for b in self.bits])
        mine, other = self.table[w][i], self.table[w][j]
        bound = np.minimum(n[i] - np.bitwise_count(mine & ~other).sum(axis=1, dtype=np.int64), n[j] - np.bitwise_count(other & ~mine).sum(axis=1, dtype=np.int64))
        return j[enough(bound, n[i], n[j], self.similarity)]


def sorted_tile(table: pa.Table, similarity) -> tuple[np.ndarray, Tile, np.ndarray]:
    order = np.lexsort((table.column("s").to_numpy(), table.column("n").to_numpy()))
    bits = [np.frombuffer(x, dtype=np.uint64) for x in table.column("bits").take(pa.array(order)).to_pylist()]
    return table.column("s").to_numpy()[order], Tile(table.column("n").to_numpy()[order].astype(np.int64), bits, similarity), order


def list_forest(similarity):
    """Function of one long list: a forest that spans the pairs that sizes and bitmaps let through."""

    def run(table: pa.Table) -> pa.Table:
        rep, tile, _ = sorted_tile(table, similarity)
        label = np.arange(len(rep))
        left, right = [], []
        for i in range(len(rep)):
            j = tile.later(i, label)
            if len(j):
                _, first = np.unique(label[j], return_index=True)
                left += [i] * len(first)
                right += j[first].tolist()
                label[np.isin(label, label[j])] = label[i]
        return pa.table({"a": rep[left], "b": rep[right]})

    return run


def list_pairs(similarity):
    """Function of one long list: all pairs of different components that sizes and bitmaps let through."""

    def run(table: pa.Table) -> pa.Table:
        rep, tile, order = sorted_tile(table, similarity)
        component = table.column("component").to_numpy()[order]
        found = [(i, tile.later(i, component)) for i in range(len(rep))]
        none = np.zeros(0, dtype=np.int64)
        return pa.table({"a": rep[np.concatenate([*(np.full(len(j), i) for i, j in found), none])], "b": rep[np.concatenate([*(j for _, j in found), none])]})

    return run


def similar_groups(docs: DataFrame, words: int = WORDS, similarity=SIMILARITY, hot: int = HOT, small: int = SMALL, group_grams: int = GROUP_GRAMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, entity_id (smallest id with the same set), component (a number of its own) and text_hash for every row."""
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text_col).toDF("id", "text")
    id_type = rows.schema["id"].dataType.simpleString()
    scanned, scan_path = store(scan_sets(rows, words))
    sets = scanned.where("kind = 0").select("id", "t", "n", "s")
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, math.ceil(total * (1 - similarity[0] / similarity[1]) / BUCKET_ENTRIES))
    entries = prefix_entries(rows.where("id IS NOT NULL"), frequent_grams(scanned), buckets, words, similarity, hot)
    find, schema = bucket_candidates(similarity, small)
    found, found_path = store(entries.groupBy("bucket").applyInArrow(find, schema))

    reps = sets.where("n > 0").groupBy("s", "n").agg(F.min("id").alias("rep")).where("rep IS NOT NULL")
    pairs, pairs_path = store(found.where("kind = 0").select(F.col("sa").alias("a"), F.col("sb").alias("b")).distinct())
    listed = cut(long_lists(found).select("list_id", "s"))
    wanted = reps.join(pairs.select(F.col("a").alias("s")).union(pairs.select("b")).union(listed.select("s")).distinct(), "s")
    bits = scanned.where("kind = 0").select(F.col("id").alias("rep"), "s", "n", "bits")
    described, bits_path = store(wanted.join(bits, ["rep", "s", "n"]).dropDuplicates(["s"]))

    forest = listed.join(described.select("s", "n", "bits"), "s").groupBy("list_id").applyInArrow(list_forest(similarity), "a long, b long")
    near = bounded(pairs, described, similarity).select("a", "b", F.lit(False).alias("star")).union(forest.distinct().select("a", "b", F.lit(True)))
    near = cut(near)
    candidate = components(near)
    sizes = described.select("s", "n").join(candidate, F.col("s") == F.col("node")).groupBy("component").agg(F.sum("n").alias("grams"))
    # One row an entity: its candidate group, its partners, and whether a long list took part.
    partners = near.groupBy("a").agg(F.collect_list("b").alias("partners"), F.max("star").alias("star"))
    members = candidate.join(sizes, "component").join(partners, F.col("node") == F.col("a"), "left").join(reps, F.col("node") == F.col("s"))
    members = cut(members.select("rep", "s", "n", F.col("component").alias("candidate"), "grams", "partners", F.coalesce("star", F.lit(False)).alias("star")))
    grouped = settle_groups(rows, members.where(F.col("grams") <= group_grams), words, similarity)
    if not (large := members.where(F.col("grams") > group_grams)).isEmpty():
        grouped = grouped.union(settle_by_joins(rows, near, large, listed, described, words, similarity))
    grouped = cut(grouped)

    lowest = reps.join(grouped, reps["s"] == grouped["node"]).groupBy("component").agg(F.min("rep").alias("lowest"))
    linked_ones = grouped.join(lowest, "component")
    entity_of = reps.join(linked_ones, reps["s"] == linked_ones["node"], "left").select("s", "n", "rep", F.coalesce("component", "s").alias("component"), F.coalesce("lowest", "rep").alias("lowest"))
    out = sets.join(entity_of, ["s", "n"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("lowest", "id").alias("component_id"), F.coalesce("rep", "id").alias("entity_id"), "component", F.col("t").alias("text_hash")
    )
    out = cut(out)
    for path in (scan_path, found_path, pairs_path, bits_path):
        drop(spark, path)
    return out


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without all but one row of each group of linked texts: that with the smallest id (then text hash) stays.

    Rows without a set or without an id are in no group, and all of them stay."""
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("t", F.xxhash64(F.col(f"c{names.index('text')}")))
    own = f"c{names.index('doc_id')}"
    groups = similar_groups(docs).where("doc_id IS NOT NULL")
    first = groups.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("one")).select("one.*", F.lit(True).alias("grouped"))
    alone = groups.where("component IS NULL").select("doc_id", "text_hash", F.lit(False).alias("grouped")).distinct()
    stay = cut(first.union(alone))
    kept = rows.join(stay, (F.col(own) == stay["doc_id"]) & (rows["t"] == stay["text_hash"]))
    single = kept.where("grouped")
    if groups.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        out = kept.select(rows.columns[:-1])
    else:
        out = single.dropDuplicates([own, "t"]).union(kept.where("NOT grouped")).select(rows.columns[:-1])
    return out.union(rows.where(F.col(own).isNull()).select(rows.columns[:-1])).toDF(*names)


def op1_jaccard_join(spark, sf_dir):
    return similar_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
