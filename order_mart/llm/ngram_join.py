"""Exact Jaccard join of word-shingle sets with set-relation skipping.

Rows with equal sets form one class, which is joined once.  The rarest-first
prefixes of the sets are an inverted index.  Its lists are sorted by set size
and position; a block is the entries of one size.  For each entry the blocks of
sizes that allow no link are skipped, so are those that its own position rules
out, and of every other block a bisect leaves the part whose positions still
allow the overlap.  Parity bitmaps (a lower bound of two sets' difference, as
wide as the smaller set) thin it further.  What the lists cannot rule out
connects sets into clusters, outside of which there is no link.

Within a cluster the answers follow the relations among sets.  A set's overlap
with its leader is computed in full and the exact differences are kept; two
sets of one leader are then answered from the leader's size and their
differences alone.  Sets already in one component need no comparison.  A
cluster too large for one task is answered pair by pair in the same way,
spread over the cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .blocks import LOWER, bounds, windows_of, words
from .common import raw_bytes, read_table, slices, stage
from .components import connected_components

SHINGLE_WORDS, PERCENT = 4, 85
#: Size of the table of shingle counts that orders the prefixes.
COUNT_BITS = 16
#: Bits of a parity map, at least and at most; between, as many as the set has shingles.
LEAST_BITS, MOST_BITS = 512, 8192
#: List entries and bytes of parity maps that one step of a list task holds, whole lists.
LIST_ROWS, LIST_BYTES, LIST_STEP = 100_000, 16 << 20, 4096
#: Lists up to so many entries are searched for entries without a partner before maps are attached.
SMALL_LIST = 256
#: Prefix places whose lists find the leaders; all places are searched after that.
LEADER_PLACES = 6
#: A cluster that one task joins has at most so many sets and compressed bytes of text.
CLUSTER_SETS, CLUSTER_BYTES = 4000, 16 << 20
#: Bits of the parity maps within a cluster.
CLUSTER_BITS = 4096


# ------------------------------------------------------------- sets
def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row with fewer words than
    ``width`` has one shingle, the whole sequence, and none without words."""
    hashes, rows = words(LOWER[data], offsets)
    shingle, first = windows_of(hashes, rows, width)
    n = len(offsets) - 1
    cut, at = bounds(rows[first], n), bounds(rows, n)
    out = []
    for r in range(n):
        if cut[r + 1] > cut[r]:
            out.append(np.unique(shingle[cut[r]: cut[r + 1]]))
        elif at[r + 1] > at[r]:
            own = slice(at[r], at[r + 1])
            out.append(windows_of(hashes[own], rows[own], at[r + 1] - at[r])[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def need(x, y, percent: int):
    """Least overlap of sets of sizes x and y that are linked."""
    return -(-percent * (x + y) // (100 + percent))


def _sets_of(frames: list[bytes], width: int) -> list[np.ndarray]:
    """Sets of compressed texts, about a megabyte of text at a time."""
    import zstandard

    unpack, out, held, total = zstandard.ZstdDecompressor(), [], [], 0
    for k, frame in enumerate(frames):
        held.append(unpack.decompress(frame))
        total += len(held[-1])
        if total >= 1 << 20 or k == len(frames) - 1:
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in held])))
            out += shingle_sets(np.frombuffer(b"".join(held), np.uint8), offsets, width)
            held, total = [], 0
    return out


def map_bits(n: int) -> int:
    """Bits of the parity map of a set of n shingles: as many at least, up to
    ``MOST_BITS``, so that sets that differ by more than a link allows do not
    fill the map."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, n - 1).bit_length()))


def parity(own: np.ndarray, bits: int) -> bytes:
    """Bit map of the shingles' last bits, each shingle flipping its bit: two
    sets differ in at least as many shingles as their maps in bits.  The two
    halves of a map, one flipped by the other, are the map of half the bits."""
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _row_task(width: int):
    """Every row's class and set size.  The last row of a task carries its
    shingle counts, each class counted once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        seen, counts, kind = set(), np.zeros(1 << COUNT_BITS, np.int64), None
        names = ["doc_id", "sid", "n", "counts"]
        for part, _, sets, _ in _sets(batches, width):
            sids = [_class_of(own) for own in sets]
            for sid, own in zip(sids, sets, strict=True):
                if sid not in seen:
                    seen.add(sid)
                    counts += np.bincount((own >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
            kind = part.column(0).type
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
                                              pa.nulls(len(sids), pa.binary())], names=names)
        if kind is not None:
            frame = zstandard.ZstdCompressor(level=3).compress(counts.tobytes())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([0], pa.int64()), pa.array([-1], pa.int64()),
                                              pa.array([frame], pa.binary())], names=names)
    return run


def _text_task(width: int):
    """(sid, text, parity): the compressed text of each class, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack, seen = zstandard.ZstdCompressor(level=3), set()
        for _, data, sets, offsets in _sets(batches, width):
            rows = []
            for k, own in enumerate(sets):
                if len(own) and (sid := _class_of(own)) not in seen:
                    seen.add(sid)
                    rows.append((sid, pack.compress(data[offsets[k]: offsets[k + 1]].tobytes()), parity(own, map_bits(len(own)))))
            if rows:
                yield _batch(["sid", "text", "parity"], rows, [pa.int64(), pa.binary(), pa.binary()])
    return run


def _batch(names: list[str], rows: list[tuple], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    for part in slices(batches, "text"):
        data, offsets, _ = raw_bytes(part.column(1))
        yield part, data, shingle_sets(data, offsets, width), offsets


def _class_of(own: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _classes(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(rows: doc_id, sid, n), (sets: sid, text, parity; one row a class, bucketed
    by class), and the counts of all shingles by hash bucket."""
    import zstandard

    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = stage(texts.mapInArrow(_row_task(width), f"doc_id {kind}, sid long, n long, counts binary"), "join-rows")

    def unpack(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    counts = np.zeros(1 << COUNT_BITS, np.int64)                 # a fixed number of sums reaches the driver
    for row in made.filter("n < 0").select("counts").mapInArrow(unpack, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[row["k"]] = row["n"]
    parts, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"shingle_sets_{uuid.uuid4().hex}"
    (texts.mapInArrow(_text_task(width), "sid long, text binary, parity binary").repartition(parts, "sid")
     .groupBy("sid").agg(F.first("text").alias("text"), F.first("parity").alias("parity"))
     .write.format("parquet").option("compression", "none").option("path", scratch_path(spark, "join-sets"))
     .bucketBy(parts, "sid").saveAsTable(table))
    return made.filter("n >= 0").select("doc_id", "sid", "n"), spark.table(table), counts


# ------------------------------------------------------------- inverted index
def prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of which linked sets share one: those that stay when as
    many as a link needs are left out, common shingles last.  Frequent are
    buckets far above the average; the order of the others is by hash."""
    n = len(own)
    often = counts[(own >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    mean = counts.mean()
    often = np.where(often > mean + 8 * np.sqrt(mean) + 8, often, 0)
    return own[np.lexsort((own, often))[: n - need_of(n, percent) + 1]]


def need_of(n: int, percent: int) -> int:
    """Least overlap of a set of size n with any set that it is linked to."""
    return -(-percent * n // 100)


def _prefix_task(width: int, percent: int, counts: np.ndarray):
    def run(batches):
        for batch in batches:
            sids, frames = (batch.column(k).to_pylist() for k in range(2))
            for at in range(0, len(sids), 500):
                sets = _sets_of(frames[at: at + 500], width)
                firsts = [prefix(own, counts, percent) for own in sets]
                sizes = np.array([len(f) for f in firsts])
                place = [(len(own) << 24) + np.arange(len(f)) for own, f in zip(sets, firsts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(np.repeat(np.array(sids[at: at + 500]), sizes)),
                     pa.array(np.concatenate(place))], names=["token", "sid", "place"])
    return run


class _Forest:
    """Components among the sets that a task has seen."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (nxt := up.get(root, root)) != root:
            root = nxt
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _partnered(place: np.ndarray, first: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """Whether an entry's list holds another that sizes and positions allow.
    Lists of more than ``SMALL_LIST`` entries are kept whole."""
    size, rest = place >> 24, (place >> 24) - (place & ((1 << 24) - 1))
    keep = np.zeros(len(place), bool)
    two = first[last - first == 2]
    fits = np.minimum(rest[two], rest[two + 1]) >= need(size[two], size[two + 1], percent)
    keep[two[fits]] = keep[two[fits] + 1] = True
    some = last - first > 2
    for a, b in zip(first[some].tolist(), last[some].tolist(), strict=True):
        if b - a > SMALL_LIST:
            keep[a:b] = True
        else:
            may = np.minimum.outer(rest[a:b], rest[a:b]) >= need(size[a:b, None], size[None, a:b], percent)
            np.fill_diagonal(may, False)
            keep[a:b] = may.any(axis=1)
    return keep


def _shared_task(percent: int):
    """Entries that may meet a partner in their list; rows come sorted by
    token.  A list that spans batches is held until it ends."""
    def emit(held: list[pa.RecordBatch], end: bool):
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        token, place = table.column(0).to_numpy(), table.column(2).to_numpy()
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        last = np.concatenate((first[1:], [len(token)]))
        if not end:                                               # the last list may go on
            rest = int(first[-1])
            first, last = first[:-1], last[:-1]
            return table.slice(0, rest).filter(pa.array(_partnered(place[:rest], first, last, percent))), [table.slice(rest)]
        return table.filter(pa.array(_partnered(place, first, last, percent))), []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if batch.column(0)[batch.num_rows - 1] != held[0].column(0)[0]:
                    out, held = emit(held, False)
                    yield out
        if held:
            yield emit(held, True)[0]
    return run


class _Maps:
    """Parity maps of a run of entries, folded to any width that is asked."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = np.diff(offsets) // 8
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        wide, at = np.zeros((0, 0), np.uint64), np.zeros(0, np.int64)
        for words in sorted(set(self.words.tolist()), reverse=True):
            while wide.shape[1] > words:
                wide = wide[:, : wide.shape[1] // 2] ^ wide[:, wide.shape[1] // 2:]
            own = np.flatnonzero(self.words == words)
            raw = data[(offsets[own][:, None] + np.arange(8 * words)).ravel()].view(np.uint64).reshape(-1, words)
            wide, at = (np.concatenate((wide, raw)), np.concatenate((at, own))) if len(at) else (raw, own)
            place = np.full(len(self.words), -1)
            place[at] = np.arange(len(at))
            self.rows[words] = wide, place

    def apart(self, i: int, j: np.ndarray) -> np.ndarray:
        """Bits in which entry i differs from entries j, which are as wide or wider."""
        maps, place = self.rows[int(self.words[i])]
        return np.bitwise_count(maps[place[j]] ^ maps[place[i]]).sum(axis=1)


class _Blocks:
    """One list, sorted by set size and position: a block is the entries of
    one size, in which positions ascend."""

    def __init__(self, place: np.ndarray, percent: int):
        self.place, self.percent = place, percent
        sizes = place >> 24
        self.first = np.flatnonzero(np.concatenate(([True], sizes[1:] != sizes[:-1])))
        self.sizes = sizes[self.first]
        self.block = np.cumsum(np.concatenate(([0], (sizes[1:] != sizes[:-1]).astype(np.int64))))

    def after(self, i: int) -> np.ndarray:
        """Later entries whose sizes and positions still allow a link with
        entry i.  Blocks of too large sets, and those that i's own position
        rules out, are skipped; of the others the part of early positions."""
        size, position = int(self.place[i]) >> 24, int(self.place[i]) & ((1 << 24) - 1)
        low = int(self.block[i])
        high = int(np.searchsorted(self.sizes, size * 100 // self.percent, side="right"))
        sizes = self.sizes[low:high]
        least = need(size, sizes, self.percent)
        sizes, least, first = (x[size - position >= least] for x in (sizes, least, self.first[low:high]))
        stop = np.searchsorted(self.place, (sizes << 24) + (sizes - least), side="right")
        start = np.maximum(first, i + 1)
        n = np.maximum(stop - start, 0)
        return np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else n


def _list_task(percent: int, every_pair: bool):
    """Candidate pairs of whole lists.

    Without ``every_pair``: pairs of a set with those close to it, which join
    the components (column ``component``) that this task meets; a list costs
    one pair for each component at most.  With it: every pair between
    different components."""
    def emit(rows, forest):
        token, sid, place, component = (np.concatenate(c) for c in list(zip(*rows, strict=True))[:4])
        maps = _Maps(np.concatenate([r[4] for r in rows]), np.concatenate(([0], np.cumsum(np.concatenate([r[5] for r in rows])))))
        sizes = place >> 24
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        last = np.concatenate((first[1:], [len(token)]))
        pairs = []
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            mine = component[a:b] if every_pair else np.array([forest.find(x) for x in component[a:b].tolist()])
            if (mine == mine[0]).all():
                continue
            blocks = _Blocks(place[a:b], percent)
            for i in range(b - a - 1):
                j = blocks.after(i)
                j = j[mine[j] != mine[i]]
                if not len(j):
                    continue
                most = sizes[a + i] + sizes[a + j] - 2 * need(sizes[a + i], sizes[a + j], percent)
                j = j[maps.apart(a + i, a + j) <= most]
                x = int(sid[a + i])
                for k in j.tolist():
                    if every_pair or forest.join(int(component[a + i]), int(component[a + k])):
                        pairs.append((x, int(sid[a + k])))
                if not every_pair and len(j):
                    mine = np.where(np.isin(mine, mine[np.concatenate(([i], j))]), mine[i], mine)
                    if (mine == mine[0]).all():
                        break
        return _batch(["a", "b"], sorted({(min(p), max(p)) for p in pairs}), [pa.int64(), pa.int64()])

    def run(batches):
        rows, held, total, forest = [], 0, 0, _Forest()
        for batch in batches:
            token, sid, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            component, start = batch.column(4).to_numpy(zero_copy_only=False), 0
            while start < len(token):
                stop = min(len(token), start + LIST_STEP)
                if held >= LIST_ROWS or total >= LIST_BYTES:      # close at the end of a list
                    other = token[start:] != rows[-1][0][-1]
                    stop = start + int(np.argmax(other)) if other.any() else len(token)
                    if stop == start:
                        yield emit(rows, forest)
                        rows, held, total = [], 0, 0
                        continue
                data, offsets, _ = raw_bytes(batch.column(3).slice(start, stop - start))
                rows.append((token[start:stop], sid[start:stop], place[start:stop], component[start:stop], data, np.diff(offsets)))
                held, total, start = held + stop - start, total + len(data), stop
        if rows:
            yield emit(rows, forest)
    return run


def _candidates(entries: DataFrame, sets: DataFrame, percent: int, parts: int, every_pair: bool) -> DataFrame:
    lists = entries.join(sets.select("sid", "parity"), "sid").select("token", "sid", "place", "parity", "component")
    return (lists.repartition(parts, "token").sortWithinPartitions("token", "place", "sid")
            .mapInArrow(_list_task(percent, every_pair), "a long, b long").distinct())


# ------------------------------------------------------------- exact answers
_ANSWER = "a long, b long, linked boolean, plus array<long>, minus array<long>"


def _sets_in(batch: pa.RecordBatch, width: int, columns: tuple[tuple[int, int], ...]) -> dict[int, np.ndarray]:
    """Sets of all texts in a batch, each made once; columns: (sid, text)."""
    frames = {}
    for sid, text in columns:
        frames.update(zip(batch.column(sid).to_pylist(), batch.column(text).to_pylist(), strict=True))
    return dict(zip(frames, _sets_of(list(frames.values()), width), strict=True))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _compare_task(width: int, percent: int):
    """Exact overlap of a and b; for linked pairs what b adds to a and lacks."""
    def run(batches):
        for batch in _parts(batches):
            sets, rows = _sets_in(batch, width, ((0, 1), (2, 3))), []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x, y = sets[a], sets[b]
                both = np.intersect1d(x, y, assume_unique=True)
                linked = len(both) >= need(len(x), len(y), percent)
                plus = np.setdiff1d(y, both, assume_unique=True).view(np.int64) if linked else None
                minus = np.setdiff1d(x, both, assume_unique=True).view(np.int64) if linked else None
                rows.append((a, b, bool(linked), plus, minus))
            yield _batch(["a", "b", "linked", "plus", "minus"], rows, [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())])
    return run


def _with_texts(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with text_a and text_b; texts stay in their buckets."""
    left = sets.select(F.col("sid").alias(a), F.col("text").alias("text_a"))
    right = sets.select(F.col("sid").alias(b), F.col("text").alias("text_b"))
    return pairs.join(left, a).join(right, b)


def _derive_task(width: int, percent: int):
    """Answers of a leader's kin for a candidate: the leader's overlap is
    computed once, each kin's follows from its differences to the leader."""
    def run(batches):
        for batch in _parts(batches):
            sets, rows = _sets_in(batch, width, ((0, 1), (2, 3))), []
            for a, y, kin in zip(*(batch.column(k).to_pylist() for k in (0, 2, 4)), strict=True):
                leader, other = sets[a], sets[y]
                overlap = len(np.intersect1d(leader, other, assume_unique=True))
                for x, plus, minus in ((k["x"], k["plus"], k["minus"]) for k in kin):
                    plus, minus = np.array(plus, np.int64).view(np.uint64), np.array(minus, np.int64).view(np.uint64)
                    own = overlap + int(np.isin(plus, other).sum()) - int(np.isin(minus, other).sum())
                    if own >= need(len(leader) + len(plus) - len(minus), len(other), percent):
                        rows.append((x, y))
            yield _batch(["a", "b"], rows, [pa.int64(), pa.int64()])
    return run


def cluster_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (by position) that connect every two linked sets of a cluster."""
    m = len(sets)
    sizes, at = np.array([len(own) for own in sets]), np.arange(m)
    maps = np.frombuffer(b"".join(parity(own, CLUSTER_BITS) for own in sets), np.uint64).reshape(m, -1)
    component, leader = at.copy(), np.full(m, -1)
    plus: list = [None] * m
    minus: list = [None] * m
    links = []
    for x in range(m):
        rest = at[x + 1:]
        rest = rest[component[rest] != component[x]]
        least = need(sizes[x], sizes[rest], percent)
        rest, least = rest[least <= np.minimum(sizes[x], sizes[rest])], least[least <= np.minimum(sizes[x], sizes[rest])]
        apart = np.bitwise_count(maps[rest] ^ maps[x]).sum(axis=1)
        may = apart <= sizes[x] + sizes[rest] - 2 * least
        for y, enough in zip(rest[may].tolist(), least[may].tolist(), strict=True):
            if component[y] == component[x]:
                continue
            if leader[x] >= 0 and leader[x] == leader[y]:        # answered from the leader's answers
                shared = len(np.intersect1d(minus[x], minus[y], assume_unique=True)) + len(np.intersect1d(plus[x], plus[y], assume_unique=True))
                overlap = sizes[leader[x]] - len(minus[x]) - len(minus[y]) + shared
            else:
                both = np.intersect1d(sets[x], sets[y], assume_unique=True)
                overlap = len(both)
                if leader[x] in (-1, x) and leader[y] == -1:
                    leader[x], plus[x], minus[x] = x, both[:0], both[:0]
                    leader[y] = x
                    plus[y], minus[y] = (np.setdiff1d(sets[k], both, assume_unique=True) for k in (y, x))
            if overlap >= enough:
                links.append((x, y))
                component[component == component[y]] = component[x]
    return links


def _cluster_task(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("sid")
        sids = table.column("sid").to_pylist()
        forest = _Forest()
        for x, y in cluster_links(_sets_of(table.column("text").to_pylist(), width), percent):
            forest.join(sids[x], sids[y])
        roots = [forest.find(sid) for sid in sids]
        return pa.table({"node": pa.array(sids, pa.int64()), "component": pa.array(roots, pa.int64())})
    return run


def _components(sets: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """(node, component) of the classes that may be linked with another."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = sets.select("sid", "text").mapInArrow(_prefix_task(width, percent, counts), "token long, sid long, place long")
    lists = index.repartition(parts, "token").sortWithinPartitions("token")
    entries = stage(lists.mapInArrow(_shared_task(percent), "token long, sid long, place long"), "join-lists")

    leading = entries.filter(F.col("place") % (1 << 24) < LEADER_PLACES).withColumn("component", F.col("sid"))
    near = stage(_candidates(leading, sets, percent, parts, every_pair=False), "join-near")
    found = stage(connected_components(near), "join-leaders")
    more = _candidates(_mixed(entries, found), sets, percent, parts, every_pair=False)
    near = stage(found.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more), "join-candidates")
    cluster = connected_components(near).withColumnRenamed("node", "sid")

    sized = cluster.join(sets.select("sid", F.length("text").alias("bytes")), "sid").groupBy("component").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("bytes").alias("bytes"))
    large = (F.col("sets") > CLUSTER_SETS) | (F.col("bytes") > CLUSTER_BYTES)
    placed = stage(cluster.join(sized.select("component", large.alias("large")), "component"), "join-clusters")
    out = (placed.filter("NOT large").select("sid", "component").join(sets.select("sid", "text"), "sid")
           .groupBy("component").applyInArrow(_cluster_task(width, percent), "node long, component long"))
    crowd = placed.filter("large").select("sid")
    if not crowd.isEmpty():
        own = near.join(crowd.withColumnRenamed("sid", "a"), "a", "left_semi")
        out = out.unionByName(connected_components(_pair_links(entries.join(crowd, "sid", "left_semi"), own, sets, width, percent, parts)))
    return out


def _mixed(entries: DataFrame, component: DataFrame) -> DataFrame:
    """Entries with their component, in lists that hold more than one."""
    return (entries.join(component.withColumnRenamed("node", "sid"), "sid", "left")
            .withColumn("component", F.coalesce("component", "sid"))
            .selectExpr("*", "min(component) OVER (PARTITION BY token) <> max(component) OVER (PARTITION BY token) AS mixed")
            .filter("mixed").drop("mixed"))


def _pair_links(entries: DataFrame, near: DataFrame, sets: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """Links of clusters too large for one task: the candidates that connect
    them are compared, then every pair between the components so found is
    answered from the leaders."""
    answers = stage(_with_texts(near.select("a", "b"), sets, "a", "b").select("a", "text_a", "b", "text_b")
                    .mapInArrow(_compare_task(width, percent), _ANSWER), "join-answers")
    linked = answers.filter("linked")
    placed = _mixed(entries, connected_components(linked.select("a", "b")))
    open_pairs = _candidates(placed, sets, percent, parts, every_pair=True).join(answers.select("a", "b"), ["a", "b"], "left_anti")
    leaders = linked.groupBy(F.col("b").alias("x")).agg(F.min(F.struct("a", "plus", "minus")).alias("near")).select("x", "near.*")
    none = F.array().cast("array<long>")
    asked = (open_pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).join(leaders, "x", "left")
             .select(F.coalesce("a", "x").alias("a"), "y", F.struct("x", F.coalesce("plus", none).alias("plus"), F.coalesce("minus", none).alias("minus")).alias("kin")))
    grouped = asked.groupBy("a", "y").agg(F.collect_list("kin").alias("kin"))
    derived = (_with_texts(grouped, sets, "a", "y").select("a", "text_a", "y", "text_b", "kin")
               .mapInArrow(_derive_task(width, percent), "a long, b long"))
    return linked.select("a", "b").unionByName(stage(derived, "join-derived"))


def jaccard_classes(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased.  Rows are
    linked when 100 * overlap >= ``percent`` * union of their shingle sets;
    component_id is the least doc_id that links reach (null ids do not count
    unless a component has no other).  A row without words has no shingles
    and is linked with nothing, not even its like: its component is itself.
    Repeated rows belong to one class.  A very long text is one set, in one
    task.  An empty table gives an empty result; further columns are ignored.
    A shingle's list of entries is held by one task.
    """
    rows, sets, counts = _classes(docs, width)
    component = _components(sets, counts, width, percent)
    placed = (rows.join(component.withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("component", F.coalesce("component", "sid")))
    placed = stage(placed, "join-placed")
    least = placed.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (placed.join(least, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read_table(spark, sf_dir, "documents"))
