"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

The pieces of a text form a lattice. A segmentation has the product of its pieces' weights as
probability. Adding Gumbel noise to the log probability of every segmentation and taking the k
largest is sampling k without replacement. The search never lists segmentations: the largest noisy
value of a whole set of segmentations is itself a Gumbel variable around the set's log mass, so an
A* search over sets expands the set with the largest value first. Picking one piece splits a set
into the segmentations with that piece and the rest; both get their values conditional on the
value of the whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from lingofold.llm.common import map_batches

#: Public vocabulary file; any path that all executors can read.
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: Rows whose samples are held at once.
SAMPLED_ROWS = 250
LOG_HALF = math.log(0.5)
STEP_BITS = 1
ALPHA = 1.0
KEPT_EDGES = 12_000_000
BATCH_CHARS = 1_200_000
#: So many choices of a path are looked at before it is known how many more can matter.
LEADING = 64
#: No noise of ``uniform`` lifts a value by more than this (36.74 at the most).
MOST_NOISE = 37.0
#: No piece reaches over two of these, so chunks can be segmented one by one.
CHUNK = re.compile(r" *[^ \n]+| +|\n")


BASE = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 18


def _hash(text: str) -> int:
    value = 0
    for character in text:
        value = (value * int(BASE) + ord(character) + 1) % (1 << 64)
    return value


class Vocabulary:
    """Pieces of a model file, with weights from the rank of the piece (they fall as 1 / rank)."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        kept = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i).replace("▁", " "): i for i in kept}
        if any(len(CHUNK.findall(piece)) > 1 for piece in self.ids):
            raise ValueError("a piece reaches over the end of a chunk")
        self.bytes = np.full(count, b"", dtype=object)
        for piece, i in self.ids.items():
            self.bytes[i] = piece.encode()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes[i] = bytes([b])
        self.log_weight = np.full(count + 1, -alpha * math.log(count))  # the last is that of byte pieces
        self.log_weight[sorted(kept)] = -alpha * np.log(np.arange(1, len(kept) + 1))
        heads = {p[:n]: -1 for p in self.ids for n in range(1, len(p) + 1)} | self.ids
        self.longest = max(map(len, heads))
        codes = {_hash(head): i for head, i in heads.items()}
        if len(codes) != len(heads):
            raise ValueError("two beginnings of pieces share a hash")
        self._place_heads(codes)

    def _place_heads(self, codes: dict[int, int]) -> None:
        """A table by the leading hash bits; where two heads want one place the later ones move on."""
        places = 1 << SLOT_BITS
        self.slot_hash = np.zeros(places + len(codes), dtype=np.uint64)
        self.slot_id = np.full(places + len(codes), -2, dtype=np.int64)
        free = 0
        for value, i in sorted((code * int(SPREAD) % (1 << 64), i) for code, i in codes.items()):
            free = max(free, value >> (64 - SLOT_BITS))
            self.slot_hash[free], self.slot_id[free] = value, i
            free += 1

    def heads(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are beginnings of pieces, the piece id of each or -1 if it is no whole piece)."""
        hashes = hashes * SPREAD
        at = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        pending = np.flatnonzero((self.slot_id[at] > -2) & (self.slot_hash[at] < hashes))
        while len(pending):  # places are filled in the order of the hashes
            at[pending] += 1
            here = at[pending]
            pending = pending[(self.slot_id[here] > -2) & (self.slot_hash[here] < hashes[pending])]
        known = np.flatnonzero((self.slot_id[at] > -2) & (self.slot_hash[at] == hashes))
        return known, self.slot_id[at[known]]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return b"".join(self.bytes[ids].tolist())[1:].decode("utf-8", "surrogatepass") if len(ids) else ""

    def expand(self, ids: np.ndarray) -> np.ndarray:
        """Piece ids with characters of several bytes outside the vocabulary as byte pieces."""
        if not len(ids) or ids.min() >= 0:
            return ids
        wide = np.flatnonzero(ids < 0)
        raw = [chr(-1 - i).encode("utf-8", "surrogatepass") for i in ids[wide].tolist()]
        sizes = np.ones(len(ids), dtype=np.int64)
        sizes[wide] = [len(b) for b in raw]
        out = np.repeat(ids, sizes)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return out


class Lattices:
    """Edges of the chunks seen so far, node after node, with their conditional probabilities.

    A node stands for a position in a chunk (``base`` has the last one); its edges are the pieces
    that end there, chosen with the share of mass that comes through them. ``log_share`` has the log
    of that share and ``above`` the shares of the edges that follow at the node, so alternatives to
    a nearly certain edge keep their weight. The edge with the largest share comes first. ``hop``
    has, side by side for the walk, the first edge of the node where an edge starts (-1 at the start of
    the chunk) and, in ``above``, the bits of a float. What is kept of a chunk does not depend on the
    other chunks, but for the places in the table. The table is emptied when it is full.
    """

    def __init__(self, vocabulary: Vocabulary, kept_edges: int = KEPT_EDGES):
        self.vocabulary, self.kept_edges = vocabulary, kept_edges
        self.clear()

    def clear(self) -> None:
        self.base: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.first = np.zeros(1, dtype=np.int64)
        self.start, self.piece = (np.zeros(0, dtype=np.int32) for _ in range(2))
        self.log_share, self.hop = np.zeros(0, dtype=np.float32), np.zeros(0, dtype=np.int64)

    @property
    def above(self) -> np.ndarray:
        return self.hop.view(np.float32)[1::2]

    def _room(self, nodes: int, edges: int) -> None:
        if self.nodes + nodes + 1 > len(self.first):
            new = np.zeros(2 * (self.nodes + nodes + 1), dtype=np.int64)
            new[: self.nodes + 1] = self.first[: self.nodes + 1]
            self.first = new
        if self.edges + edges > len(self.start):
            size = max(self.kept_edges // 4, self.edges * 3 // 2) + edges
            for name in ("start", "piece", "log_share", "hop"):
                old = getattr(self, name)
                new = np.empty(size, dtype=old.dtype)
                new[: self.edges] = old[: self.edges]
                setattr(self, name, new)

    def ends(self, chunks: list[str]) -> np.ndarray:
        """The last node of every chunk; chunks that are not in the table are added."""
        found = np.fromiter(map(self.base.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        if self.edges > self.kept_edges:
            self.clear()
            missing = np.arange(len(chunks))
        own = list(map(chunks.__getitem__, missing.tolist()))
        self.add(list(dict.fromkeys(own)))
        found[missing] = np.fromiter(map(self.base.__getitem__, own), dtype=np.int64, count=len(own))
        return found

    def add(self, new: list[str]) -> None:
        begin, stop_at, start, stop, piece = self._edges(new)
        log_share, order = self._shares(begin, start, stop, piece, stop_at)
        start, stop, piece, log_share = start[order], stop[order], piece[order], log_share[order]
        total = int(begin[-1])
        self._room(total, len(start))
        counts = np.bincount(stop, minlength=total)
        edge_at = np.concatenate([[0], np.cumsum(counts)])
        counts = counts[counts > 0]
        heads = np.cumsum(counts) - counts
        self._largest_first(heads, counts, start, piece, log_share)
        part = slice(self.edges, self.edges + len(start))
        low = np.flatnonzero((piece < 0) & (piece >= -128))  # characters of one byte
        piece[low] = self.vocabulary.byte_ids[-1 - piece[low]]
        self.start[part], self.piece[part], self.log_share[part] = start + self.nodes, piece, log_share
        self.first[self.nodes : self.nodes + total + 1] = self.edges + edge_at
        hop = self.hop[part].view(np.int32)
        hop[::2] = np.where(edge_at[start + 1] > edge_at[start], self.edges + edge_at[start], -1)
        hop[1::2].view(np.float32)[:] = self._following(heads, counts, np.exp(log_share))
        self.base.update(zip(new, (begin[1:] - 1 + self.nodes).tolist(), strict=True))
        self.nodes += total
        self.edges += len(start)

    @staticmethod
    def _largest_first(heads: np.ndarray, counts: np.ndarray, start, piece, log_share) -> None:
        """Swap the first edge of every node with the one that has the largest share."""
        top = np.flatnonzero(log_share == np.repeat(np.maximum.reduceat(log_share, heads), counts))
        node = np.searchsorted(heads, top, side="right")
        top = top[np.diff(node, prepend=0) > 0]
        for values in (start, piece, log_share):
            values[heads], values[top] = values[top], values[heads]

    @staticmethod
    def _following(heads: np.ndarray, counts: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Sum of the shares behind each edge at its node, added up node by node from the last one."""
        behind = np.repeat(heads + counts, counts) - 1 - np.arange(len(share))
        kind = np.int16 if len(counts) and counts.max() < 1 << 15 else np.int64
        order = np.argsort(behind.astype(kind), kind="stable")
        cuts = np.cumsum(np.bincount(behind))
        above = np.zeros(len(share))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[lo:hi]
            above[at] = above[at + 1] + share[at + 1]
        return above

    def _edges(self, chunks: list[str]):
        """All pieces at all places: first node per chunk, end position, start node, end node, piece."""
        vocabulary = self.vocabulary
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        begin = np.concatenate([[0], np.cumsum(lengths + 1)])
        which = np.repeat(np.arange(len(chunks)), lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = lengths[which] - place
        node = begin[which] + place
        alive, hashes = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        starts, sizes, pieces = [], [], []
        bare = np.ones(len(codes), dtype=bool)
        for size in range(1, vocabulary.longest + 1):
            fits = left[alive] >= size
            alive, hashes = alive[fits], hashes[fits]
            if not len(alive):
                break
            hashes = hashes * BASE + codes[alive + size - 1] + np.uint64(1)
            known, ids = vocabulary.heads(hashes)
            alive, hashes = alive[known], hashes[known]
            whole = ids >= 0
            starts.append(alive[whole])
            pieces.append(ids[whole])
            sizes.append(np.full(int(whole.sum()), size))
            if size == 1:
                bare[alive[whole]] = False
        bare = np.flatnonzero(bare)
        starts.append(bare)
        pieces.append(-1 - codes[bare].astype(np.int64))
        sizes.append(np.ones(len(bare), dtype=np.int64))
        at, size, piece = np.concatenate(starts), np.concatenate(sizes), np.concatenate(pieces)
        return begin, place[at] + size, node[at], node[at] + size, piece

    def _shares(self, begin, start, stop, piece, stop_at):
        """Log share of each edge in the mass that reaches its end, by a forward pass over positions."""
        by_end = np.argsort(stop, kind="stable")
        kind = np.int16 if stop_at.max() < 1 << 15 else np.int64  # short integers are sorted by radix
        order = by_end[np.argsort(stop_at[by_end].astype(kind), kind="stable")]
        weight = self.vocabulary.log_weight[np.maximum(piece, -1)]
        mass, share = np.zeros(int(begin[-1])), np.zeros(len(start))
        edges = np.searchsorted(stop_at[order], np.arange(1, int(stop_at.max()) + 2))
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            part = order[lo:hi]
            ends = stop[part]
            heads = np.flatnonzero(np.diff(ends, prepend=-1))
            sizes = np.diff(np.append(heads, hi - lo))
            value = mass[start[part]] + weight[part]
            top = np.maximum.reduceat(value, heads)
            sums = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, sizes)), heads))
            mass[ends[heads]] = sums
            share[part] = value - np.repeat(sums, sizes)
        return share, by_end


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of the given integers."""
    x = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (x ^ np.asarray(part, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(29))
    return x


def mixed_on(key: np.ndarray, number: np.ndarray) -> np.ndarray:
    """One more number mixed into a hash."""
    with np.errstate(over="ignore"):
        x = (key ^ number.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def uniform(key: np.ndarray, number: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the given integers only."""
    with np.errstate(over="ignore"):
        x = (key ^ np.asarray(number, dtype=np.uint64)) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * (1.0 / (1 << 52))


def truncated(location: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values around ``location``, given that they do not exceed ``top``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        value = location - np.log(np.exp(location - top) - np.log(u))
    return np.where(location > -np.inf, np.minimum(value, top), -np.inf)


@dataclass
class Path:
    """One segmentation: its edges in the order of choice, and the sets split off along them.

    ``rest`` has the values of those sets, from ``fresh`` on and as far as ``leading_rests`` goes.
    """

    edges: np.ndarray
    chunks: np.ndarray
    before: np.ndarray
    log_prob: float
    value: float
    fresh: int
    rest: np.ndarray
    taken: dict[int, list[int]] = field(default_factory=dict)


def walk(lat: Lattices, node: np.ndarray, keys: np.ndarray):
    """Choose pieces from the end of each chunk back to its start, all chunks in step.

    Returns (edges, chunk index) ordered by chunk and then by choice. ``node`` is where a chunk
    starts to be chosen; a node without edges is the start of its chunk. ``keys`` seed the choices.
    """
    n = len(node)
    edge = lat.first[node]
    active = np.flatnonzero(lat.first[node + 1] > edge)
    edge = edge[active]
    steps, whose, count, k = [], [], np.zeros(n, dtype=np.int64), 0
    while len(active):
        u = uniform(keys[active], k)
        hop = lat.hop[edge].view(np.int32)
        late = np.flatnonzero(u <= hop[1::2].view(np.float32))
        if len(late):
            again = late
            while len(late):
                edge[late] += 1
                late = late[u[late] <= lat.above[edge[late]]]
            hop[2 * again] = lat.hop[edge[again]].view(np.int32)[::2]
        steps.append(edge)
        whose.append(active)
        count[active] += 1
        go = np.flatnonzero(hop[::2] >= 0)
        active, edge, k = active[go], hop[::2][go].astype(np.int64), k + 1
    offset = np.concatenate([[0], np.cumsum(count)])
    edges = np.zeros(offset[-1], dtype=np.int64)
    for step, (edge, index) in enumerate(zip(steps, whose, strict=True)):
        edges[offset[index] + step] = edge
    return edges, np.repeat(np.arange(n), count), offset


def leading_rests(lat: Lattices, paths: list[tuple], k: int) -> list[np.ndarray]:
    """Per path, given as (key, before, edges, log shares, value, fresh), the values of the sets split off
    at its first choices. Those left out lie below the k largest ones, so k rounds never reach them: the
    probability falls along a path, and noise lifts a value by ``MOST_NOISE`` at the most.
    """
    if not paths:
        return []
    keys, values = np.array([p[0] for p in paths], dtype=np.uint64), np.array([p[4] for p in paths])

    def rests(low: list[int], high: list[int]) -> list[np.ndarray]:
        before, edges, shares = (
            np.concatenate([p[j][lo:hi] for p, lo, hi in zip(paths, low, high, strict=True)]) for j in (1, 2, 3)
        )
        index = np.concatenate([np.arange(p[5] + lo, p[5] + hi) for p, lo, hi in zip(paths, low, high, strict=True)])
        sizes = np.subtract(high, low)
        with np.errstate(divide="ignore"):
            left = np.log(lat.above[edges].astype(np.float64))
        small = np.flatnonzero(shares <= LOG_HALF)  # a likely edge stands first: what is left is the others' sum
        left[small] = np.log1p(-np.exp(shares[small]))
        out = truncated(before + left, np.repeat(values, sizes), uniform(np.repeat(keys, sizes), index))
        ends = np.cumsum(sizes).tolist()
        return [out[end - size : end] for end, size in zip(ends, sizes.tolist(), strict=True)]

    lead = max(LEADING, k)
    near = [min(len(p[1]), lead) for p in paths]
    out, far = rests([0] * len(paths), near), []
    for path, rest, n in zip(paths, out, near, strict=True):
        before = path[1]
        if n < len(before):
            open_at = np.flatnonzero(before >= np.partition(rest, n - k)[n - k] - MOST_NOISE)
            n = max(n, int(open_at[-1]) + 1)
        far.append(n)
    if far == near:
        return out
    return [np.concatenate([a, b]) for a, b in zip(out, rests(near, far), strict=True)]


def sample_batch(texts: list[str | None], seeds: list[int], lat: Lattices, k: int) -> tuple[list[list[Path]], list[float]]:
    """Per text up to k segmentations in falling order of their noisy value, and the next value.

    The value of number k + 1 is the threshold of the inclusion scores, minus infinity when there
    are no more segmentations. A text without more has fewer than k; an empty text has none.
    """
    chunked = [CHUNK.findall(" " + t)[::-1] if t else [] for t in texts]  # chosen from the end back
    end = lat.ends(list(chain.from_iterable(chunked)))
    sizes = np.array([len(c) for c in chunked], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    seed = np.array(seeds, dtype=np.uint64)
    ordinal = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)

    def logs(edges):
        return lat.log_share[edges].astype(np.float64)

    def finish(key, edges, own, chunks, head_edges, head_chunks, head_before, value, fresh):
        """A path from the choices of its parent before the split and the fresh ones behind it; its
        rest comes later."""
        before = np.zeros(len(edges))
        start = 0.0
        if len(head_edges):
            start = head_before[-1] + logs(head_edges[-1])
        total = start
        if len(edges):
            sums = np.cumsum(own)
            before[0], before[1:] = start, start + sums[:-1]
            total = start + sums[-1]
        fresh_ones.append((key, before, edges, own, float(value), fresh))
        if len(head_edges):
            edges, chunks = np.concatenate([head_edges, edges]), np.concatenate([head_chunks, chunks])
            before = np.concatenate([head_before, before])
        return Path(edges, chunks, before, float(total), float(value), fresh, none_f)

    none_i, none_f = np.zeros(0, dtype=np.int64), np.zeros(0)
    found: list[list[Path]] = [[] for _ in texts]
    edges, owner, offset = walk(lat, end, mixed_on(np.repeat(mixed(0, seed), sizes), ordinal << STEP_BITS))
    keys = mixed(seed, 0)
    values = -np.log(-np.log(uniform(keys, 1 << 41)))
    own, fresh_ones, having = logs(edges), [], np.flatnonzero(sizes).tolist()
    for doc in having:
        part = slice(offset[bounds[doc]], offset[bounds[doc + 1]])
        found[doc].append(finish(keys[doc], edges[part], own[part], owner[part] - bounds[doc], none_i, none_i, none_f, values[doc], 0))
    for doc, rest in zip(having, leading_rests(lat, fresh_ones, k), strict=True):
        found[doc][-1].rest = rest
    for number in range(1, k):
        todo = []
        keys = mixed(seed, number)
        for_pick, for_rest = uniform(keys, 1 << 42), uniform(keys, 1 << 43)
        for doc in range(len(texts)):
            paths = found[doc]
            if len(paths) < number:
                continue
            tops = [p.rest.max() if len(p.rest) else -np.inf for p in paths]
            parent = paths[int(np.argmax(tops))]
            value = max(tops)
            if value == -np.inf:
                continue
            at = parent.fresh + int(parent.rest.argmax())
            node = node_of(lat, parent.edges[at])
            first, last = lat.first[node : node + 2].tolist()
            gone = parent.taken.setdefault(at, [int(parent.edges[at])])
            open_edges = [e for e in range(first, last) if e not in gone]
            mass = np.exp(logs(np.array(open_edges)))
            u = for_pick[doc] * mass.sum()
            nth = min(int(np.searchsorted(np.cumsum(mass), u)), len(open_edges) - 1)
            pick = open_edges[nth]
            gone.append(pick)
            mass[nth] = 0
            location = parent.before[at] + (math.log(mass.sum()) if mass.any() else -np.inf)
            parent.rest[at - parent.fresh] = truncated(np.float64(location), np.float64(value), for_rest[doc])
            todo.append((doc, parent, at, pick, value))
        if not todo:
            break
        nodes, keys_at, orders, steps, cuts = [], [], [], [], [0]
        doc_keys = mixed(number, seed)
        for doc, parent, at, pick, _ in todo:
            chunk = int(parent.chunks[at])
            later = np.arange(bounds[doc] + chunk + 1, bounds[doc + 1])
            nodes.append(np.concatenate([[lat.start[pick]], end[later]]))
            keys_at.append(np.full(len(later) + 1, doc_keys[doc]))
            orders.append(np.concatenate([[chunk], ordinal[later]]))
            steps.append(np.concatenate([[1], np.zeros(len(later), dtype=np.int64)]))
            cuts.append(cuts[-1] + len(later) + 1)
        order = np.concatenate(orders)
        edges, owner, offset = walk(
            lat, np.concatenate(nodes), mixed_on(np.concatenate(keys_at), (order << STEP_BITS) | np.concatenate(steps))
        )
        own, fresh_ones = logs(edges), []
        for (doc, parent, at, pick, value), lo, hi in zip(todo, cuts[:-1], cuts[1:], strict=True):
            part = slice(offset[lo], offset[hi])
            head_edges = np.append(parent.edges[:at], pick)
            found[doc].append(finish(
                keys[doc], edges[part], own[part], order[owner[part]], head_edges, parent.chunks[: at + 1], parent.before[: at + 1], value, at + 1,
            ))
        for (doc, *_), rest in zip(todo, leading_rests(lat, fresh_ones, k), strict=True):
            found[doc][-1].rest = rest
    return found, [max((p.rest.max(initial=-np.inf) for p in paths), default=-np.inf) for paths in found]


def node_of(lat: Lattices, edge: int) -> int:
    """The node at which an edge ends."""
    return int(np.searchsorted(lat.first[: lat.nodes + 1], edge, side="right")) - 1


def pieces_in_order(path: Path, lat: Lattices) -> np.ndarray:
    """Piece ids of a path in text order (the choices run backwards)."""
    return lat.piece[path.edges[::-1]]


class Sampler:
    """Seeded samples of texts; the vocabulary and the lattices stay in the worker."""

    def __init__(self, path: str, k: int, alpha: float, seed: int, kept_edges: int = KEPT_EDGES):
        self.path, self.k, self.alpha, self.seed, self.kept_edges = path, k, alpha, seed, kept_edges
        self.lattices: Lattices | None = None

    def __getstate__(self):
        return self.__dict__ | {"lattices": None}

    def run(self, keys: list, texts: list[str | None]):
        """Yields (row, sample number, ids, log_prob, log_inclusion), taking about
        ``BATCH_CHARS`` characters at a time (fewer with small tables)."""
        start, held, most = 0, 0, min(BATCH_CHARS, self.kept_edges // 10)
        for stop, text in enumerate(texts, 1):
            held += len(text or "")
            if held >= most or stop == len(texts):
                for row, *found in self._some(keys[start:stop], texts[start:stop]):
                    yield (start + row, *found)
                start, held = stop, 0

    def _some(self, keys: list, texts: list[str | None]):
        if self.lattices is None:
            self.lattices = Lattices(Vocabulary(self.path, self.alpha), self.kept_edges)
        lat = self.lattices
        seeds = [xxhash.xxh64_intdigest(repr(key).encode(), seed=self.seed) for key in keys]
        found, thresholds = sample_batch(texts, seeds, lat, self.k)
        for row, (paths, threshold) in enumerate(zip(found, thresholds, strict=True)):
            if not paths:
                yield row, 1, np.zeros(0, dtype=np.int32), 0.0, 0.0
            for number, path in enumerate(paths, 1):
                ids = lat.vocabulary.expand(pieces_in_order(path, lat))
                yield row, number, ids, path.log_prob, log_inclusion(path.log_prob, threshold)


def log_inclusion(log_prob: float, threshold: float) -> float:
    """Log probability that a segmentation's noisy value exceeds the threshold."""
    gap = log_prob - threshold
    if gap > 36:
        return 0.0
    return gap if gap < -36 else math.log(-math.expm1(-math.exp(gap)))


def encode_samples(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES,
    model_path: str = DEFAULT_MODEL, alpha: float = ALPHA, seed: int = 0,
    kept_edges: int = KEPT_EDGES,
) -> DataFrame:
    """Up to ``k`` distinct segmentations per row: key, sample, ids, log_prob, log_inclusion.

    Samples depend on the key, the text and ``seed`` only, not on the partitioning; rows that
    repeat a key and a text get the same samples. A text with fewer than ``k`` segmentations gives all
    of them (inclusion 1). Null and empty texts give one empty segmentation. Characters without a
    piece become byte pieces, so decoding gives back the whole text. Other columns are not read.
    """
    sampler = Sampler(model_path, k, alpha, seed, kept_edges)

    def encode(batch: dict) -> dict:
        keys = batch[key_col]
        rows = [(keys[i], *found) for i, *found in sampler.run(keys, batch[text_col])]
        names = [key_col, "sample", "ids", "log_prob", "log_inclusion"]
        return {n: [r[j] for r in rows] for j, n in enumerate(names)}

    kind = docs.schema[key_col].dataType.simpleString()
    schema = f"`{key_col}` {kind}, sample int, ids array<int>, log_prob double, log_inclusion double"
    return map_batches(docs.select(key_col, text_col), encode, schema, SAMPLED_ROWS)


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "text", model_path: str = DEFAULT_MODEL) -> DataFrame:
    """Replace piece ids by their text; null ids give a null text."""
    kept = [f for f in rows.schema.fields if f.name not in (ids_col, text_col)]
    known: list[Vocabulary] = []

    def read(batch: dict) -> dict:
        if not known:
            known.append(Vocabulary(model_path))
        texts = [None if ids is None else known[0].decode(ids) for ids in batch[ids_col]]
        return {f.name: batch[f.name] for f in kept} | {text_col: texts}

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{text_col}` string"])
    return map_batches(rows.select(*[f.name for f in kept], ids_col), read, schema)


def encode_and_verify(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES,
    model_path: str = DEFAULT_MODEL, alpha: float = ALPHA, seed: int = 0,
) -> DataFrame:
    """``encode_samples`` with each sample decoded again where it was made: key, sample, n_pieces,
    log_prob, log_inclusion, ids_xxh64 (hex), round_trip (whether the whole text came back) and
    ids, the piece ids as little-endian 32-bit numbers behind each other, of which ids_xxh64 is the hash.

    Null and empty texts give one sample without pieces. Rows with a null key are seeded alike, rows
    that repeat a key and a text get equal samples, and an empty table gives no rows.
    """
    sampler = Sampler(model_path, k, alpha, seed)

    def encode(batch: dict) -> dict:
        rows = []
        keys, texts = batch[key_col], batch[text_col]
        for i, number, ids, log_prob, inclusion in sampler.run(keys, texts):
            packed = ids.astype("<i4").tobytes()
            digest = xxhash.xxh64_hexdigest(packed)
            same = sampler.lattices.vocabulary.decode(ids) == (texts[i] or "")
            rows.append((keys[i], number, len(ids), log_prob, inclusion, digest, same, packed))
        names = [key_col, "sample", "n_pieces", "log_prob", "log_inclusion", "ids_xxh64", "round_trip", "ids"]
        return {n: [r[j] for r in rows] for j, n in enumerate(names)}

    kind = docs.schema[key_col].dataType.simpleString()
    schema = (
        f"`{key_col}` {kind}, sample int, n_pieces int, log_prob double, log_inclusion double, "
        "ids_xxh64 string, round_trip boolean, ids binary"
    )
    return map_batches(docs.select(key_col, text_col), encode, schema)
