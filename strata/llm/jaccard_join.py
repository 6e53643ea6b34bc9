"""N-gram Jaccard join: sets of word shingles, linked by a prefix-tree join.

1. One pass over the texts writes (id, set size, 128-bit digest of the set). Equal
   sets are one set from here: only one row of each goes on, by a sieve (a Bloom
   filter) where there are copies. A sieve may let more pass, which costs work only.
2. Of each set the 2/5 least hashes (at t = 0.75) are dealt by hash range, cut to the
   bits that tell them apart, and the numbers of shared ones go back. Sets that have
   too few to reach t with any other set go no further (a second sieve, see _enough).
3. The shingles of the others are dealt by hash range, packed, and those that more
   than one set has go back to their documents, as numbers that rise with the count
   of their sets; all others belong to one set only. The global order is: such unique
   shingles first, then by number. A document's copies in one task, and a shingle's
   documents in one task, are combined before the shuffle.
   Two sets with similarity >= t share one of their n - ceil(t n) + 1 first
   shingles. Sets that share one are put in the same block (star edges,
   combined within each task before the shuffle; components of the stars).
4. Each block is joined by a prefix tree that holds the sets from their most
   frequent shingle on, so that near copies share long paths. A probe carries
   the overlap with the path and leaves a subtree when the lengths left can't
   reach t, or when all below is already in its component. Blocks above
   ``block_tokens`` are cut twice into parts, each a task. Sets outside the
   largest component that this gives then meet each of its parts and each other.
5. Links (a spanning forest of each block) give the components.

Shingles are compared by 64-bit hashes, and sets are named by 64-bit digests. Nulls, empty and blank texts have an
empty set: size 0, linked with nothing. Rows with equal ids and texts get equal
results; a null id never names a component unless it is alone.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.components import connected_components
from strata.llm.store import kept, written
from strata.session import drop_scratch

PARTS = 64
NARROW = "id long, h long, n long, d1 long, d2 long"


def _sets(column: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of every row."""
    for lo, _, data, offsets in tx.chunks(column):
        _, _, hashes, first = tx.words(data, offsets, tx.NOT_SPACE)
        for i, s in enumerate(tx.shingles(hashes, first, k)):
            yield lo + i, np.unique(s)


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return (int.from_bytes(d[:8], "little", signed=True),
            int.from_bytes(d[8:], "little", signed=True))


def _profile(k: int):
    schema = pa.schema([(c, pa.int64()) for c in ("id", "h", "n", "d1", "d2")])

    def run(batches):
        for b in batches:
            n, d1, d2 = [], [], []
            for _, s in _sets(b.column(1), k):
                n.append(len(s))
                a, c = _digest(s) if len(s) else (None, None)
                d1.append(a)
                d2.append(c)
            yield tx.batch(schema, id=b.column(0), h=b.column(2), n=n, d1=d1, d2=d2)

    return run


class _Sieve:
    """A Bloom filter of 64-bit names in PARTS slices of bits: never misses one that it holds."""

    def __init__(self, slices: np.ndarray):
        self.slices = slices

    @staticmethod
    def places(names: np.ndarray, size: int) -> np.ndarray:
        """The bits of each name in its slice of ``size`` bits (a power of two)."""
        x = tx.mix(names.view(np.uint64))
        step = tx.mix(x + np.uint64(1)) | np.uint64(1)
        return ((x + np.arange(4, dtype=np.uint64)[:, None] * step) & np.uint64(size - 1)).astype(np.int64)

    def has(self, names: np.ndarray) -> np.ndarray:
        at = self.places(names, 8 * self.slices.shape[1])
        bits = self.slices[names & (PARTS - 1), at >> 3] >> (at & 7).astype(np.uint8)
        return (bits & 1).all(axis=0)


def _fill(size: int):
    """The slice of each part among (part, name) as they stream by."""

    def run(batches):
        slices: dict[int, np.ndarray] = {}
        for b in batches:
            part, names = b.column(0).to_numpy(), b.column(1).to_numpy()
            for p in np.unique(part).tolist():
                slices.setdefault(p, np.zeros(size, bool))[_Sieve.places(names[part == p], size)] = True
        if slices:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(slices), pa.int32()),
                pa.array([np.packbits(x, bitorder="little").tobytes() for x in slices.values()], pa.binary())],
                ["part", "bits"])

    return run


def _sieve(names: DataFrame, rows: int, width: int) -> Broadcast:
    """A broadcast sieve of ``rows`` names (column row), of 16 bits each or 16 bytes times ``width`` in all."""
    size = max(8, 1 << math.ceil(math.log2(min(max(16 * rows, 1 << 16), 128 * width) / PARTS)))
    slices = np.zeros((PARTS, size // 8), np.uint8)
    packed = (names.select(F.col("row").bitwiseAND(PARTS - 1).cast("int").alias("part"), "row")
              .repartition(PARTS, "part").mapInArrow(_fill(size), "part int, bits binary"))
    for r in packed.collect():
        slices[r.part] = np.frombuffer(r.bits, np.uint8)
    return names.sparkSession.sparkContext.broadcast(_Sieve(slices))


class _Forest:
    """Union-find whose roots are the least members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def pairs(self) -> tuple[list[int], list[int]]:
        nodes = list(self.up)
        return nodes, [self.find(x) for x in nodes]


def _planes(values: np.ndarray) -> bytes:
    """64-bit values in as few bytes each as the largest needs (first byte: how many)."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _values(packed: bytes) -> np.ndarray:
    flat = np.frombuffer(packed, np.uint8)
    width, n = int(flat[0]), (len(flat) - 1) // int(flat[0])
    values = np.zeros((n, 8), np.uint8)
    values[:, :width] = flat[1:].reshape(width, n).T
    return values.reshape(-1).view("<u8")


def _pack(tokens: np.ndarray) -> bytes:
    """Ascending 64-bit values: the first, then differences of equal width."""
    return tokens[:1].astype("<u8").tobytes() + _planes(np.diff(tokens))


def _unpack(packed: bytes) -> np.ndarray:
    steps = np.concatenate([np.frombuffer(packed[:8], "<u8"), _values(packed[8:])])
    return np.cumsum(steps, dtype=np.uint64)


#: key: hash range or, for what stays with its run of documents, anything; chunk: the run.
#: _ONCE: tokens of a range that one document of the run has, with the document of each (rows);
#: _OFTEN: tokens that several have, with the number of the first and the documents of each (rows);
#: _INFO: rows and sizes of the run's documents; _WHO: the documents (rows) and how many (tokens) of each _OFTEN token
_EXCHANGE = "key int, chunk long, kind int, rows binary, tokens binary"
_EXCHANGE_SCHEMA = pa.schema([("key", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()),
                              ("rows", pa.binary()), ("tokens", pa.binary())])
_ONCE, _OFTEN, _INFO, _WHO = range(4)
_CHUNK_TOKENS, _CHUNK_ROWS = 1 << 20, 65_000


class _Messages:
    """Rows of _EXCHANGE, gathered for one batch."""

    def __init__(self):
        self.columns: dict[str, list] = {f.name: [] for f in _EXCHANGE_SCHEMA}

    def put(self, key, chunk, kind, rows, tokens) -> None:
        for column, v in zip(self.columns.values(), (key, chunk, kind, rows, tokens)):
            column.append(v)

    def batch(self) -> pa.RecordBatch:
        return tx.batch(_EXCHANGE_SCHEMA, **self.columns)


def _chunks(batches, k: int, sieve: Broadcast | None, some):
    """(number, documents, tokens, rows) of runs of documents (text, row) that the sieve lets pass, each set once.

    The documents have digest, size and row; tokens are ascending, with the document of each in rows.
    ``some(n)`` of a set's n tokens are taken, the least ones.
    """
    chunk = TaskContext.get().partitionId() << 32
    held, seen, info, size = [], set(), [], 0

    def ended():
        tokens = np.concatenate(held)
        rows = np.repeat(np.arange(len(held), dtype=np.uint16), [len(h) for h in held])
        order = np.argsort(tokens, kind="stable")
        return chunk, np.array(info, np.int64), tokens[order], rows[order]

    for b in batches:
        texts, names = b.column(0), b.column(1).to_numpy()
        if sieve is not None:
            inside = sieve.value.has(names)
            texts, names = texts.filter(pa.array(inside)), names[inside]
        for i, s in _sets(texts, k):
            if not len(s) or (digest := _digest(s)) in seen:
                continue
            seen.add(digest)
            info.append((*digest, len(s), int(names[i])))
            held.append(s[:some(len(s))].copy())
            size += len(held[-1])
            if size >= _CHUNK_TOKENS or len(held) >= _CHUNK_ROWS:
                yield ended()
                chunk += 1
                held, seen, info, size = [], set(), [], 0
    if held:
        yield ended()


def _firsts(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending tokens: which are the first of their value, and which are alone."""
    new = np.ones(len(tokens) + 1, bool)
    new[1:-1] = tokens[1:] != tokens[:-1]
    return new[:-1], new[:-1] & new[1:]


def _ranges(tokens: np.ndarray, range_bits: int):
    """(range, from, to) of ascending tokens by their first bits."""
    cuts = np.searchsorted(tokens >> np.uint64(64 - range_bits), np.arange((1 << range_bits) + 1))
    for key in np.flatnonzero(np.diff(cuts)).tolist():
        yield key, int(cuts[key]), int(cuts[key + 1])


def _token_samples(k: int, percent: int, range_bits: int, shift: int, sieve: Broadcast | None):
    """The least tokens of each set by hash range, ``shift`` bits cut off. See _enough for how many."""

    def run(batches):
        for chunk, info, tokens, rows in _chunks(batches, k, sieve, lambda n: n - n * percent * 4 // 500):
            new, alone = _firsts(tokens)
            out = _Messages()
            often = np.bincount(rows[~alone], minlength=len(info))
            out.put(chunk % (1 << range_bits), chunk, _INFO,
                    np.column_stack([info[:, 3], info[:, 2], often]).astype(np.int64).tobytes(), None)
            for kind, which in ((_ONCE, alone), (_OFTEN, new & ~alone)):
                some, documents = tokens[which], rows[which]
                for key, lo, hi in _ranges(some, range_bits):
                    out.put(key, chunk, kind, documents[lo:hi].tobytes() if kind == _ONCE else None,
                            _pack(some[lo:hi] >> np.uint64(shift)))
            yield out.batch()

    return run


def _shared_samples(batches):
    """Of each hash range, the documents (once for each token) of tokens that another run or document has."""
    for group in tx.runs(batches, ["key"]):
        kind = group["kind"].to_numpy()
        yield from group.filter(pa.array(kind == _INFO)).to_batches()
        group = group.filter(pa.array(kind != _INFO))
        if not group.num_rows:
            continue
        tokens = [_unpack(t.as_py()) for t in group["tokens"]]
        source = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        tokens = np.concatenate(tokens)
        order = np.argsort(tokens, kind="stable")
        shared = np.zeros(len(tokens), bool)
        shared[order] = ~_firsts(tokens[order])[1]
        cuts = np.searchsorted(source, np.arange(group.num_rows + 1))
        out = _Messages()
        for i, (chunk, kind, rows) in enumerate(zip(*(group[c].to_pylist() for c in ("chunk", "kind", "rows")))):
            if kind == _ONCE and (some := shared[cuts[i]:cuts[i + 1]]).any():
                out.put(None, chunk, _ONCE, np.frombuffer(rows, np.uint16)[some].tobytes(), None)
        yield out.batch()


_CANDIDATES = "row long, n long"


def _enough(percent: int):
    """(row, size) of the sets that can have a near copy by what is shared of their least tokens.

    Of n tokens the n - floor(u n) least are looked at, with u = 4/5 of the threshold t. Near copies
    of sizes a <= b share o >= t b tokens, and all but floor(u b) of these are among the least tokens
    of both: at least o - floor(u b) >= (t - u) b >= (t - u) a. So a set of n tokens needs (t - u) n there.
    """

    def run(batches):
        schema = pa.schema([("row", pa.int64()), ("n", pa.int64())])
        for group in tx.runs(batches, ["chunk"]):
            kind = np.array(group["kind"].to_pylist())
            info = np.frombuffer(group["rows"][int(np.flatnonzero(kind == _INFO)[0])].as_py(), np.int64).reshape(-1, 3)
            shared = info[:, 2].copy()
            for i in np.flatnonzero(kind == _ONCE).tolist():
                shared += np.bincount(np.frombuffer(group["rows"][i].as_py(), np.uint16), minlength=len(info))
            some = shared >= np.maximum(1, -(-info[:, 1] * percent // 500))
            yield tx.batch(schema, row=info[some, 0], n=info[some, 1])

    return run


def _token_ranges(k: int, range_bits: int, sieve: Broadcast | None):
    """Tokens of runs of documents, by hash range. A token that several documents of a run
    have leaves the run once, however many they are."""

    def run(batches):
        for chunk, info, tokens, rows in _chunks(batches, k, sieve, lambda n: n):
            new, alone = _firsts(tokens)
            out = _Messages()
            out.put(chunk % (1 << range_bits), chunk, _INFO, info[:, :3].tobytes(), None)
            some, documents = tokens[alone], rows[alone]
            for key, lo, hi in _ranges(some, range_bits):
                out.put(key, chunk, _ONCE, documents[lo:hi].tobytes(), _pack(some[lo:hi]))
            if not alone.all():
                counts = np.diff(np.flatnonzero(np.append(new, True)[np.append(~alone, True)])).astype(np.uint32)
                out.put(chunk % (1 << range_bits), chunk, _WHO, rows[~alone].tobytes(), counts.tobytes())
                some = tokens[new & ~alone]
                for key, lo, hi in _ranges(some, range_bits):
                    out.put(key, chunk, _OFTEN, np.append(np.uint32(lo), counts[lo:hi]).tobytes(), _pack(some[lo:hi]))
            yield out.batch()

    return run


def _shared_tokens(range_bits: int):
    """Of each hash range, the tokens that more than one document has, sent back to their runs as numbers:
    the fewer documents have a token, the lower its number, about alike in all ranges."""

    def run(batches):
        for group in tx.runs(batches, ["key"]):
            kind = group["kind"].to_numpy()
            yield from group.filter(pa.array(kind >= _INFO)).to_batches()
            group = group.filter(pa.array(kind < _INFO))
            if not group.num_rows:
                continue
            key, kinds, chunks = group["key"][0].as_py(), group["kind"].to_numpy(), group["chunk"].to_pylist()
            rows = [np.frombuffer(r.as_py(), np.uint16 if x == _ONCE else np.uint32)
                    for r, x in zip(group["rows"], kinds)]
            tokens = [_unpack(t.as_py()) for t in group["tokens"]]
            cuts = np.cumsum([0, *map(len, tokens)])
            documents = np.concatenate([np.ones(len(r), np.uint32) if x == _ONCE else r[1:]
                                        for r, x in zip(rows, kinds)])
            distinct, back = np.unique(np.concatenate(tokens), return_inverse=True)
            documents = np.bincount(back, documents, len(distinct))
            order = np.argsort(documents, kind="stable")
            order = order[documents[order] > 1]
            number = np.full(len(distinct), -1, np.int64)
            number[order] = (np.arange(len(order)) << range_bits) + key
            number, out = number[back], _Messages()
            for i, (r, x, chunk) in enumerate(zip(rows, kinds.tolist(), chunks)):
                own = number[cuts[i]:cuts[i + 1]]
                if x == _OFTEN:
                    out.put(None, chunk, x, r[:1].tobytes(), _planes(own))
                elif (some := np.flatnonzero(own >= 0)).size:
                    some = some[np.argsort(own[some])]
                    out.put(None, chunk, x, r[some].tobytes(), _pack(own[some].astype(np.uint64)))
            yield out.batch()

    return run


_SETS = "d1 long, n long, keep int, size int, tokens binary"
_SETS_SCHEMA = pa.schema([("d1", pa.int64()), ("n", pa.int64()), ("keep", pa.int32()), ("size", pa.int32()),
                          ("tokens", pa.binary())])


def _ordered_sets(percent: int):
    """Sets whose prefix holds a shared token: their shared tokens from the rarest on, and how many are in the prefix."""

    def run(batches):
        for group in tx.runs(batches, ["chunk"]):
            found: list[list] = [[], [], [], []]
            for kind, r, t in zip(group["kind"].to_pylist(), group["rows"], group["tokens"]):
                found[kind].append((r.as_py(), t.as_py()))
            info = np.frombuffer(found[_INFO][0][0], np.int64).reshape(-1, 3)
            rows = [np.frombuffer(r, np.uint16) for r, _ in found[_ONCE]]
            tokens = [_unpack(t) for _, t in found[_ONCE]]
            for r, t in found[_WHO]:
                counts = np.frombuffer(t, np.uint32)
                numbers = np.zeros(len(counts), np.uint64)
                for first, some in found[_OFTEN]:
                    lo, some = int(np.frombuffer(first, np.uint32)[0]), _values(some)
                    numbers[lo:lo + len(some)] = some
                rows.append(np.frombuffer(r, np.uint16))
                tokens.append(np.repeat(numbers, counts))
            if not rows:
                continue
            rows, tokens = np.concatenate(rows), np.concatenate(tokens)
            order = np.lexsort((tokens, rows))
            rows, tokens = rows[order], tokens[order]
            cuts = np.searchsorted(rows, np.arange(len(info) + 1))
            out: dict[str, list] = {f.name: [] for f in _SETS_SCHEMA}
            for i, (d1, _, n) in enumerate(info.tolist()):
                lo, hi = int(cuts[i]), int(cuts[i + 1])
                keep = n - (percent * n + 99) // 100 + 1 - (n - (hi - lo))
                if keep <= 0 or lo == hi:
                    continue  # the prefix has only tokens of its own
                for name, v in zip(out, (d1, n, min(keep, hi - lo), hi - lo, _pack(tokens[lo:hi]))):
                    out[name].append(v)
            if out["d1"]:
                yield tx.batch(_SETS_SCHEMA, **out)

    return run


def _prefix_rows(batches):
    """(token, node, null): the prefix of each set, once per token; (key, node, other): star edges found here."""
    schema = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        nodes, keep = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        tokens = [_unpack(t.as_py())[:m] for t, m in zip(batch.column(4), keep.tolist())]
        tokens = np.concatenate(tokens or [np.zeros(0, np.uint64)]).astype(np.int64)
        nodes = np.repeat(nodes, keep)
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order]
        new = np.ones(len(tokens), bool)
        new[1:] = tokens[1:] != tokens[:-1]
        pivot = nodes[np.flatnonzero(new)[np.cumsum(new) - 1]]
        other = nodes != pivot
        forest = _Forest()
        for a, b in np.unique(np.stack([nodes[other], pivot[other]], 1), axis=0).tolist():
            forest.join(a, b)
        a, b = forest.pairs()
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[new]), pa.array(nodes[new]),
             pa.nulls(int(new.sum()), pa.int64())], schema=schema)
        if a:
            yield tx.batch(schema, token=a, a=a, b=b)


def _star_edges(batches):
    """Rows sorted by token: links every node of a token to its first one."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    forest, last, pivot = _Forest(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        token, a = (batch.column(i).to_numpy() for i in range(2))
        edge = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        for x, y in zip(a[edge].tolist(), batch.column(2).drop_null().to_pylist()):
            forest.join(x, y)
        token, a = token[~edge], a[~edge]
        if len(token):
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            new[0] = last is None or token[0] != last
            group = np.cumsum(new) - 1
            starts = a[new]
            first = np.where(group >= 0, starts[np.maximum(group, 0)], pivot) if len(starts) else np.full(len(a), pivot)
            other = first != a
            if other.any():
                for x, y in np.unique(np.stack([a[other], first[other]], 1), axis=0).tolist():
                    forest.join(x, y)
            last, pivot = token[-1], int(first[-1])
        if len(forest.up) > 1 << 20:
            x, y = forest.pairs()
            yield tx.batch(schema, a=x, b=y)
            forest = _Forest()
    x, y = forest.pairs()
    yield tx.batch(schema, a=x, b=y)


class _Node:
    __slots__ = ("chain", "bag", "depth", "lo", "hi", "kids", "short", "long", "most", "tag")


def _build(seqs: list[list[int]], sizes: list[int]) -> list[_Node]:
    """Prefix tree over sorted sequences; a node holds a run of shared items. Parents come first."""
    nodes: list[_Node] = []

    def grow(lo: int, hi: int, depth: int) -> int:
        a, b = seqs[lo], seqs[hi - 1]
        end, most = depth, min(len(a), len(b))
        while end < most and a[end] == b[end]:
            end += 1
        node = _Node()
        node.chain, node.depth, node.lo, node.hi, node.kids = a[depth:end], end, lo, hi, []
        node.bag, node.tag = frozenset(node.chain), None
        node.short, node.long = min(sizes[lo:hi]), max(sizes[lo:hi])
        node.most = max(map(len, seqs[lo:hi])) - end
        nodes.append(node)
        return len(nodes) - 1

    stack = [grow(0, len(seqs), 0)] if seqs else []
    while stack:
        node = nodes[stack.pop()]
        i, end = node.lo, node.depth
        while i < node.hi and len(seqs[i]) == end:
            i += 1  # these end here; they sort first
        while i < node.hi:
            item, j = seqs[i][end], i + 1
            while j < node.hi and seqs[j][end] == item:
                j += 1
            node.kids.append(grow(i, j, end))
            stack.append(node.kids[-1])
            i = j
    return nodes


def tree_links(ids: list[int], sizes: list[int], sets: list[np.ndarray], percent: int,
               sides: list[int] | None = None) -> tuple[list[int], list[int]]:
    """(member, least member) of each group linked by 100 |A and B| >= percent |A or B|.

    ``sets`` may lack tokens that no other set has; ``sizes`` counts them.
    Items are renumbered by falling frequency. ``sides`` (0 or 1 each) limits
    the search to pairs from two parts of a split block.
    """
    _, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
    items = rank[back]
    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    rows = sorted((np.sort(items[cut[i]:cut[i + 1]]).tolist(), i) for i in range(len(sets)))
    seqs, at, full = [r[0] for r in rows], [ids[r[1]] for r in rows], [sizes[r[1]] for r in rows]
    side = [sides[r[1]] if sides else 0 for r in rows]
    bags = [frozenset(s) for s in seqs]
    forest = _Forest()

    def linked(i: int, j: int) -> bool:
        both = len(bags[i] & bags[j])
        return 100 * both >= percent * (full[i] + full[j] - both)

    # neighbours in tree order, and the middle one, are likely links: fewer parts to search
    hub = len(seqs) // 2
    for i in range(len(seqs)):
        if i and (not sides or side[i] != side[i - 1]) and linked(i - 1, i):
            forest.join(at[i - 1], at[i])
        elif i != hub and (not sides or side[i] != side[hub]) and linked(hub, i):
            forest.join(at[hub], at[i])
    nodes = _build(seqs, full)

    def retag() -> None:
        for node in nodes:
            root = forest.find(at[node.lo])
            node.tag = root if all(forest.find(at[x]) == root for x in range(node.lo + 1, node.hi)) else None

    retag()
    for q, seq in enumerate(seqs):
        if q % 512 == 511:
            retag()
        own, bag, size = forest.find(at[q]), bags[q], full[q]
        stack = [(0, 0)]
        while stack:
            x, both = stack.pop()
            node = nodes[x]
            if node.lo >= q or node.tag is not None and forest.find(node.tag) == own:
                continue
            left = len(seq)
            if node.chain:
                both += len(bag & node.bag)
                left -= bisect_right(seq, node.chain[-1])
            short = max(node.short, -(-percent * size // 100))
            if short > min(node.long, size * 100 // percent):
                continue
            reach = both + min(node.most, left)  # all that is left on the shorter side
            if 100 * reach < percent * (size + short - reach):
                continue
            i = node.lo
            while i < node.hi and len(seqs[i]) == node.depth:
                if (i < q and (not sides or side[i] != side[q])
                        and 100 * both >= percent * (size + full[i] - both)):
                    forest.join(at[i], at[q])
                    own = forest.find(at[q])
                i += 1
            for kid in node.kids:
                stack.append((kid, both))
    return forest.pairs()


def _block_links(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for group in tx.runs(batches, ["block", "i", "j"]):
            member = {}  # copies of one set can come from several tasks
            for x, node in enumerate(group["d1"].to_pylist()):
                member.setdefault(node, x)
            pick = list(member.values())
            sets = [_unpack(group["tokens"][x].as_py()) for x in pick]
            sizes, names, side = (group[c].to_pylist() for c in ("n", "name", "side"))
            a, b = tree_links([names[x] for x in pick], [sizes[x] for x in pick], sets, percent,
                              None if side[0] is None else [side[x] for x in pick])
            if a:
                yield tx.batch(schema, a=a, b=b)

    return run


def _links(dealt: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the names of sets dealt to the tasks (block, i, j)."""
    return (dealt.select("block", "i", "j", "side", "name", "d1", "n", "tokens")
            .repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
            .mapInArrow(_block_links(percent), "a long, b long"))


def _splits(members: DataFrame, name: str, block_tokens: int, block_members: int) -> DataFrame:
    """(block, ``name``): the parts into which the (d1, block, size) of a block are cut."""
    return members.groupBy("block").agg(F.greatest(F.ceil(F.sum("size") / block_tokens),
                                                   F.ceil(F.count("*") / block_members)).cast("int").alias(name))


def _part(splits: str, seed: int | Column = 0) -> Column:
    return F.pmod(F.xxhash64("d1", F.lit(seed) if isinstance(seed, int) else seed), F.col(splits)).cast("int")


def _within(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each set of a block dealt to one part; in a block of several, to one of another cut as well,
    so that near copies join across parts."""
    deal = F.explode(F.when(F.col("splits") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (sets.join(blocks, "d1").withColumn("i", deal)
            .withColumn("j", _part("splits", F.col("i")))
            .withColumn("side", F.lit(None).cast("int")).withColumn("name", F.col("d1")))


def _across(sets: DataFrame, blocks: DataFrame, found: DataFrame, block_tokens: int, block_members: int) -> DataFrame:
    """Pairs of split blocks that parts of their own have not settled.

    Sets in the largest component of a block need no comparison with each other. All other sets,
    the rest, meet every part of it and each other. Sets go by the name of their component.
    """
    cut = (blocks.filter("splits > 1").join(found, blocks["d1"] == found["node"], "left")
           .select("d1", "block", "splits", "size", F.coalesce("component", "d1").alias("name")))
    main = (cut.groupBy("block", "name").agg(F.count("*").alias("members"))
            .groupBy("block").agg(F.max_by("name", F.struct("members", "name")).alias("main")))
    cut = cut.join(main, "block").withColumn("rest", F.col("name") != F.col("main"))
    cut = written(cut.join(_splits(cut.filter("rest"), "rest_splits", block_tokens, block_members), "block"),
                  "jaccard-cut")  # a block without a rest is settled
    part, rest_part = _part("splits"), _part("rest_splits")

    def task(i: Column, j: Column, side: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    def each(splits: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(splits) - 1), make)

    to_rest = each("rest_splits", lambda r: task(r, part, F.lit(0)))
    to_main = each("splits", lambda p: task(rest_part, p, F.lit(1)))
    to_each_other = each("rest_splits", lambda o: task(
        F.least(rest_part, o), F.col("splits") + F.greatest(rest_part, o),
        F.when(rest_part == o, F.lit(None)).otherwise((rest_part > o).cast("int"))))
    tasks = F.when(F.col("rest"), F.concat(to_main, to_each_other)).otherwise(to_rest)
    return sets.join(cut, "d1").select("d1", "n", "tokens", "block", "name", F.inline(tasks))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                       k: int = 5, percent: int = 75, width: int = 1 << 20,
                       range_tokens: int = 1 << 19,
                       block_tokens: int = 1 << 18, block_members: int = 1024,
                       text_hash: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    With ``text_hash`` also xxhash64 of the text under that name, which tells rows apart
    that share an id.

    ``width`` limits the sieves of sets, 16 bytes each: the only data that goes through
    the driver or is broadcast. It affects the work, never the result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h"))
    narrow = written(base.mapInArrow(_profile(k), NARROW), "jaccard-profile")
    row = F.xxhash64("id", "h").alias("row")
    reps = written(narrow.filter("n > 0").select("id", "n", "d1", "d2", row).groupBy("d1", "d2")
                           .agg(F.min("id").alias("rep"), F.min("row").alias("row"), F.first("n").alias("n"),
                                F.count("*").alias("copies")), "jaccard-reps")
    texts = base.select("text", row)

    def size(names: DataFrame) -> tuple[int, int]:
        rows, total = names.agg(F.count("*"), F.sum("n")).first()
        return rows, total or 0

    def ranges(total: float) -> int:
        return max(4, math.ceil(math.log2(max(1, total / range_tokens))))

    distinct, total = size(reps)
    sieve = _sieve(reps, distinct, width) if reps.filter("copies > 1").limit(1).count() else None
    bits, digits = ranges(total * (1 - percent / 125)), max(1, total).bit_length() + 8
    candidates, candidates_path = kept(
        texts.mapInArrow(_token_samples(k, percent, bits, 64 - min(64, max(digits, bits)), sieve), _EXCHANGE)
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_shared_samples, _EXCHANGE)
        .repartition("chunk").sortWithinPartitions("chunk")
        .mapInArrow(_enough(percent), _CANDIDATES), "jaccard-candidates")
    some, total = size(candidates)
    bits, sieve = ranges(total), _sieve(candidates, some, width)
    sets = written(
        texts.mapInArrow(_token_ranges(k, bits, sieve), _EXCHANGE)
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_shared_tokens(bits), _EXCHANGE)
        .repartition("chunk").sortWithinPartitions("chunk")
        .mapInArrow(_ordered_sets(percent), _SETS), "jaccard-sets")
    drop_scratch(spark, candidates_path)
    edges = (sets.mapInArrow(_prefix_rows, "token long, a long, b long")
             .repartition("token").sortWithinPartitions("token")
             .mapInArrow(_star_edges, "a long, b long"))
    blocks = (connected_components(edges)
              .select(F.col("node").alias("d1"), F.col("component").alias("block")))
    members = sets.select("d1", "size").distinct().join(blocks, "d1")
    blocks = members.join(_splits(members, "splits", block_tokens, block_members), "block")
    blocks = written(blocks, "jaccard-blocks")
    narrow_sets = sets.select("d1", "n", "tokens")
    found = connected_components(_links(_within(narrow_sets, blocks), percent))
    if blocks.filter("splits > 1").limit(1).count():
        found = written(found, "jaccard-components")
        more = _links(_across(narrow_sets, blocks, found, block_tokens, block_members), percent)
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                     .unionByName(more))
    named = reps.select("d1", "d2", "rep").join(found.select(F.col("node").alias("d1"), "component"), "d1", "left")
    least = (named.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least")))
    named = named.join(least, "component", "left").select(
        "d1", "d2", F.coalesce("least", "rep").alias("component_id"))
    return (narrow.join(named, ["d1", "d2"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    *([F.col("h").alias("text_hash")] if text_hash else [])))
