"""SentencePiece encoding with distinct sampled segmentations, and decoding.

The segmentations of a text by the vocabulary's pieces form a lattice.  A piece
of merge rank r has weight 1 / (r + SHIFT) ** SHARPNESS, a segmentation the product of its pieces'
weights, normalised to a probability.  Each row gets its ``k`` segmentations of
largest Gumbel-perturbed log probability: a sample without replacement (Gumbel
top-k).  They are found by best-first (A*) search: the perturbed value of a
partial segmentation is the largest one among all its completions and is drawn
top down from the lattice's backward sums, so the search opens the best
open prefix, and every path it completes is the next sample.  Only the path of a
sample is opened node by node; the siblings along it stay one entry each (their
joint probability, and their largest perturbed value under the parent's).

Each sample has its log probability, its perturbed value, and an inclusion score,
the log of the probability that its perturbed value exceeds the (k+1)-th largest
one, 0 where there is none (a log, for a long text's is too small for a double).  All random numbers are hashes of (row key, sample, place), so that they do
not depend on partitions or on other rows.

No piece crosses into a run of spaces, so the lattice is a chain of small
lattices, one per word; equal words in a slice of rows share one, and all rows
of a slice are searched side by side in numpy.  A word of over ``LONGEST`` characters is
cut further only between two characters that no piece has side by side, so that every
segmentation stays possible.  A character without a piece is spelled in byte pieces.

Defined results: a NULL or empty text has one segmentation, of no piece, with
log inclusion 0; a text with fewer than k segmentations gives all of them; repeated rows give
repeated samples; only the key and text columns are read; an empty table gives an empty
result.  A literal U+2581 reads as a space, as in the vocabulary's library.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from stratum.llm.common import mix64, text_slices, uniform

SPACE = "▁"
LONGEST = 64
SHIFT, SHARPNESS = 10.0, 1.0
SLICE = 1 << 18  # bytes of text searched side by side; arrays take about 400 bytes per character
KEPT = 1 << 21  # nodes of lattices that a worker keeps from slice to slice; a slice that needs more has its own
_UNITS = re.compile(" *+[^ \n]+| +|\n")


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)


class Vocabulary:
    """Pieces of a model file as a trie in sorted arrays, with log weights."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = np.full(256, -1, np.int64)
        normal = []
        for i in range(n):
            if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i):
                continue
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_ids[b] = i
                self.bytes_of[i] = bytes([b])
            else:
                normal.append(i)
                self.bytes_of[i] = piece.encode()
        self.shown = pa.array([b.replace(SPACE.encode(), b" ") for b in self.bytes_of], pa.large_binary())
        rank = np.empty(len(normal))
        rank[np.argsort([-lib.get_score(i) for i in normal], kind="stable")] = np.arange(len(normal))
        self.weight = np.full(n, -SHARPNESS * np.log(len(normal) + SHIFT))
        self.weight[normal] = -SHARPNESS * np.log(rank + SHIFT)
        nodes, steps = {"": 0}, {}
        ends, pairs = {}, {-1}
        for i in normal:
            piece = lib.id_to_piece(i)
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"a piece crosses a space: {piece!r}")
            if "\n" in piece and piece != "\n":
                raise ValueError(f"a piece crosses a line end: {piece!r}")
            pairs.update(ord(a) << 21 | ord(b) for a, b in zip(piece, piece[1:]))
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    steps[nodes[piece[:k - 1]] << 21 | ord(piece[k - 1])] = nodes[piece[:k]]
            ends[nodes[piece]] = i
        self.deepest = max((len(piece) for piece in nodes), default=0)
        self.lattice = Lattice(self)  # kept over slices, see Search
        # the trie's steps, each at the first free slot from its key's hash on
        self.bits = (4 * len(steps) + 4).bit_length()
        self.keys, self.child = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        key, child = np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64)
        slot = self.slots(key)
        while len(key):
            _, one = np.unique(slot, return_index=True)
            one = one[self.keys[slot[one]] < 0]
            self.keys[slot[one]], self.child[slot[one]] = key[one], child[one]
            key, child, slot = (np.delete(x, one) for x in (key, child, slot))
            slot = (slot + 1) & ((1 << self.bits) - 1)
        self.pairs = np.array(sorted(pairs), np.int64)  # characters that some piece has side by side
        self.piece_at = np.full(len(nodes), -1, np.int64)
        self.piece_at[list(ends)] = list(ends.values())

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie's next states, -1 where no piece goes on so."""
        key = state << 21 | char
        slot = self.slots(key)
        child, held = self.child[slot], self.keys[slot]
        child[held != key] = -1
        more = np.flatnonzero((held != key) & (held >= 0))
        while len(more):
            slot[more] = at = (slot[more] + 1) & (len(self.keys) - 1)
            held = self.keys[at]
            hit = held == key[more]
            child[more[hit]] = self.child[at[hit]]
            more = more[~hit & (held >= 0)]
        return child

    def units(self, text: str) -> list[str]:
        return [u.replace(" ", SPACE) for u in self.words(text)]

    def words(self, text: str) -> list[str]:
        """The units, with plain spaces."""
        units = _UNITS.findall(" " + text.replace(SPACE, " ")) if text else []
        if max(map(len, units), default=0) > LONGEST:
            units = list(chain.from_iterable(self.parts(u) if len(u) > LONGEST else (u,) for u in units))
        return units

    def parts(self, unit: str) -> list[str]:
        """A long unit cut at all places that no piece can cross."""
        chars = _code_points(unit)
        pair = chars[:-1] << 21 | chars[1:]
        found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cuts = [0, *(np.flatnonzero(self.pairs[found] != pair) + 1).tolist(), len(unit)]
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of segmentations that lie end to end."""
        data = self.shown.take(pa.array(ids))  # the pieces' texts, end to end
        cuts = np.frombuffer(data.buffers()[1], np.int64, len(ids) + 1, data.offset * 8)[bounds]
        texts = pa.Array.from_buffers(pa.large_utf8(), len(bounds) - 1, [None, pa.py_buffer(cuts), data.buffers()[2]])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # byte pieces that spell no character
            raw = pa.Array.from_buffers(pa.large_binary(), len(texts), texts.buffers()).to_pylist()
            texts = pa.array([t.decode("utf-8", "replace") for t in raw], pa.large_utf8())
        return pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts).cast(pa.string())

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Index(dict):
    """Units numbered in the order they are first seen; ``unseen`` lists those that came since it was emptied."""

    def __init__(self):
        self.unseen: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.unseen.append(unit)
        return n


class Lattice:
    """Lattices of distinct units, end to end: nodes are the places between characters, and each node's
    edges lie together, with their probabilities given the node.  A unit's lattice does not depend on the others,
    so units are added as texts bring them, and kept."""

    def __init__(self, voc: Vocabulary):
        self.voc, self.index = voc, _Index()
        self.room = {name: np.empty(0, kind) for name, kind in (
            ("first", np.int64), ("last", np.int64), ("edges", np.int64), ("stop", np.int64), ("piece", np.int32),
            ("log_p", np.float64), ("upto", np.float64))}
        self.first, self.last, _, self.stop, self.piece, self.log_p, self.upto = self.room.values()
        self.edges, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.append("edges", np.zeros(1, np.int64))

    def append(self, name: str, values: np.ndarray) -> None:
        """Values after those of an array, which has room to spare."""
        size = len(getattr(self, name))
        room = self.room[name]
        if size + len(values) > len(room):
            room = np.empty(max(size + len(values), len(room) + len(room) // 2), room.dtype)
            room[:size] = getattr(self, name)
            self.room[name] = room
        room[size:size + len(values)] = values
        setattr(self, name, room[:size + len(values)])

    def numbers(self, texts: list[list[str]], total: int) -> np.ndarray:
        """The numbers of all units of texts; the lattices of unseen ones are still to be added."""
        return np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, total)

    def full(self) -> bool:
        """Whether the unseen units would make the lattices kept from earlier slices too large."""
        more = len(self.index.unseen) + sum(map(len, self.index.unseen))
        return 1 < len(self.edges) and len(self.edges) + more > KEPT

    def note(self, of: np.ndarray) -> None:
        """Count the slices that have each unit."""
        now = np.zeros(len(self.first), np.int32)
        now[of] = 1
        now[:len(self.uses)] += self.uses
        self.uses = now

    def shed(self) -> None:
        """Half the room at most stays taken, by the units of most slices; those of one slice go."""
        size = self.last - self.first + 1
        order = np.argsort(-self.uses, kind="stable")
        keep = np.sort(order[(np.cumsum(size[order]) <= KEPT // 2) & (self.uses[order] > 1)])
        names, size, first = list(self.index), size[keep], self.first[keep]
        begin, count = self.edges[first], self.edges[self.last[keep]] - self.edges[first]
        at, to = _ranges(begin, count), np.cumsum(size) - size
        degree = np.diff(self.edges)[_ranges(first, size)]
        kept = {"first": to, "last": to + size - 1, "edges": np.r_[0, np.cumsum(degree)],
                "stop": self.stop[at] + np.repeat(to - first, count), "piece": self.piece[at], "log_p": self.log_p[at],
                "upto": self.upto[at]}
        large = len(self.edges) > KEPT
        for name, values in kept.items():
            if large:
                self.room[name] = np.empty(0, self.room[name].dtype)
            setattr(self, name, self.room[name][:0])
            self.append(name, values)
        self.uses = self.uses[keep] >> 1
        self.index.clear()
        self.index.unseen = []
        self.index.update((names[i], n) for n, i in enumerate(keep.tolist()))

    def add_unseen(self) -> None:
        units, self.index.unseen = self.index.unseen, []
        if not units:
            return
        voc, nodes, edges = self.voc, len(self.edges) - 1, len(self.stop)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        chars = _code_points("".join(units))
        first = np.cumsum(sizes + 1) - sizes - 1  # a unit's first node
        last = first + sizes
        n = int(last[-1]) + 1
        left = np.repeat(last, sizes + 1) - np.arange(n)  # characters from each node to its unit's end
        node = np.flatnonzero(left)  # the node before each character
        room = left[node]
        # per node the pieces that begin there, longest first
        bits = max(voc.deepest - 1, 0).bit_length()
        wide, none = 1 << bits, np.iinfo(np.int32).min
        found = np.full(n << bits, none, np.int32)
        at, state, depth = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        while len(at):
            state = voc.step(state, chars[at + depth])
            ok = np.flatnonzero(state >= 0)
            at, state = at[ok], state[ok]
            depth += 1
            piece = voc.piece_at[state]
            here = np.flatnonzero(piece >= 0)
            found[(node[at[here]] << bits) + (wide - depth)] = piece[here]
            more = np.flatnonzero(room[at] > depth)
            at, state = at[more], state[more]
        single = (node << bits) + (wide - 1)
        bare = np.flatnonzero(found[single] == none)  # no piece for the character: its bytes, as one edge
        found[single[bare]] = -1 - chars[bare]
        cell = np.flatnonzero(found != none)
        piece, start = found[cell], cell >> bits
        stop = start + (wide - (cell & (wide - 1)))
        del found, cell
        degree = np.bincount(start, minlength=n)
        weight = voc.weight[np.maximum(piece, 0)]
        spelled = np.flatnonzero(piece < 0)
        letters, of = np.unique(piece[spelled], return_inverse=True)
        sums = [voc.weight[voc.byte_ids[list(chr(-1 - c).encode())]].sum() for c in letters.tolist()]
        weight[spelled] = np.array(sums)[of] if len(sums) else 0.0
        # backward sums, from the places next to a unit's end to those furthest from it
        beta, value = np.zeros(n), np.empty(len(start))
        far, most = left[start], int(left.max())
        by = np.argsort(far.astype(np.min_scalar_type(most)), kind="stable")  # small types sort fast
        bounds = np.cumsum(np.bincount(far, minlength=most + 1))
        begin, end, load = start[by], stop[by], weight[by]
        heads = np.flatnonzero(np.r_[True, begin[1:] != begin[:-1]])
        width = np.diff(np.r_[heads, len(begin)])
        level = np.searchsorted(heads, bounds)
        begin = begin[heads]
        for a, b, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), level[:-1].tolist(), level[1:].tolist()):
            if a < b:
                load[a:b] += beta[end[a:b]]
                v, h = load[a:b], heads[c:d] - a
                top = np.maximum.reduceat(v, h)
                beta[begin[c:d]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, width[c:d])), h))
        value[by] = load
        log_p = np.minimum(value - beta[start], 0.0)
        upto, offset = np.exp(log_p), np.cumsum(degree) - degree  # cumulative probability within the node
        more = np.flatnonzero(degree > 1)
        for step in range(1, int(degree.max())):
            more = more[degree[more] > step]
            at = offset[more] + step
            upto[at] += upto[at - 1]
        upto[(offset + degree - 1)[degree > 0]] = np.inf  # the last edge is taken if no other is
        self.append("first", first + nodes)
        self.append("last", last + nodes)
        self.append("edges", offset[1:] + edges)
        self.append("edges", np.array([edges + len(start)]))
        for name, values in (("stop", stop + nodes), ("piece", piece), ("log_p", log_p), ("upto", upto)):
            self.append(name, values)

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge out of each node, by its probability."""
        e = self.edges[node]
        more = np.flatnonzero(u > self.upto[e])
        u = u[more]
        while len(more):
            at = e[more] + 1
            e[more] = at
            go = np.flatnonzero(u > self.upto[at])
            more, u = more[go], u[go]
        return e


class Paths:
    """One complete path per row, rows end to end: edges, running sums of their log probabilities, and for each place
    the largest perturbed value among the siblings left open there (-inf: none, or not among the largest), which is
    known for ``drawn`` places from ``first`` on."""

    def __init__(self, bounds, edge, place, unit, sums, open_, log_prob, first, drawn):
        self.bounds, self.edge, self.place, self.unit, self.sums, self.open = bounds, edge, place, unit, sums, open_
        self.log_prob, self.first, self.drawn = log_prob, first, drawn
        self.top, self.where = np.full(len(bounds) - 1, -np.inf), np.zeros(len(bounds) - 1, np.int64)
        self.changed = np.flatnonzero(drawn)  # rows whose largest open value is to be looked for

    def look(self) -> None:
        """Each row's largest open value, and the first index that has it."""
        rows, self.changed = self.changed, np.zeros(0, np.int64)
        if not len(rows):
            return
        size = self.drawn[rows]
        index = _ranges(self.first[rows], size)
        values = self.open[index]
        self.top[rows] = top = np.maximum.reduceat(values, np.cumsum(size) - size)
        hit = np.flatnonzero(values == np.repeat(top, size))[::-1]
        self.where[np.repeat(rows, size)[hit]] = index[hit]  # the first of equals


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for size[0] numbers, then the next."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - np.r_[0, ends[:-1]], size)


REACH = 37.0  # over -log(2 ** -53), the largest Gumbel value that a double between 0 and 1 gives


def _under(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel value of this location, given that it is at most ``bound``; it is below location + REACH."""
    with np.errstate(divide="ignore", invalid="ignore"):
        value = location - np.log(np.exp(np.minimum(location - bound, 700)) - np.log(np.minimum(u, 1 - 2.0 ** -53)))
    return np.where(np.isneginf(location), -np.inf, value)


class Search:
    """Gumbel top-k over the segmentations of many rows side by side."""

    def __init__(self, texts: list[list[str]], keys: np.ndarray, voc: Vocabulary):
        count = np.fromiter(map(len, texts), np.int64, len(texts))
        self.units = voc.lattice.numbers(texts, int(count.sum()))
        if voc.lattice.full():
            voc.lattice.shed()
            self.units = voc.lattice.numbers(texts, int(count.sum()))
        self.lat = voc.lattice
        self.lat.add_unseen()
        self.lat.note(self.units)
        self.row_end = np.cumsum(count)
        self.row_start = self.row_end - count
        size = self.lat.last - self.lat.first
        chars = np.cumsum(size[self.units]) if len(self.units) else np.zeros(0, np.int64)
        self.offset = chars - size[self.units]  # characters before each unit; rows differ by their key
        self.offset = self.offset - np.repeat(np.r_[self.offset, 0][np.minimum(self.row_start, len(self.offset))], count)
        self.keys = keys
        self.longest = int(np.bincount(np.repeat(np.arange(len(keys)), count), size[self.units], len(keys)).max(initial=0))
        self.hashed: dict[np.uint64, np.ndarray] = {}

    def draw(self, keys: np.ndarray, sample: int, purpose: int, place: np.ndarray) -> np.ndarray:
        """Uniform numbers for (row key, sample, purpose, place)."""
        tag = np.uint64((sample << 4 | purpose) << 40)
        if tag not in self.hashed and len(place) > self.longest:  # rows share their places: hash each but once
            self.hashed[tag] = mix64(np.arange(self.longest + 1, dtype=np.uint64) + tag)
        hashed = self.hashed[tag][place] if tag in self.hashed else mix64(place.astype(np.uint64) + tag)
        return uniform(mix64(keys ^ hashed))

    def walk(self, row: np.ndarray, unit: np.ndarray, node: np.ndarray, sample: int):
        """Sample on from each node to the end of its unit: (item, edge, place) in order of item and place."""
        lat, item, key = self.lat, np.arange(len(row)), self.keys[row]
        stop, base = lat.last[self.units[unit]], self.offset[unit] - lat.first[self.units[unit]]
        items, edges, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        live = np.flatnonzero(node < stop)
        while len(live):
            if len(live) < len(item):
                item, node, key, base, stop = (x[live] for x in (item, node, key, base, stop))
            place = base + node
            e = lat.choose(node, self.draw(key, sample, 1, place))
            items.append(item)
            edges.append(e)
            places.append(place)
            node = lat.stop[e]
            live = np.flatnonzero(node < stop)
        item = np.concatenate(items)
        order = np.argsort(item.astype(np.min_scalar_type(len(row))), kind="stable")  # small types sort fast
        return item[order], np.concatenate(edges)[order], np.concatenate(places)[order]

    def top(self, k: int):
        """For each sample in turn: (paths, rows that have it, log probability, perturbed value); then the bound
        that the (k+1)-th value gives (-inf: none)."""
        lat, n = self.lat, len(self.keys)
        rows = np.repeat(np.arange(n), self.row_end - self.row_start)
        item, edge, place = self.walk(rows, np.arange(len(rows)), lat.first[self.units], 0)
        best = -np.log(-np.log(self.draw(self.keys, 0, 2, np.zeros(n, np.int64))))
        bounds = np.r_[0, np.searchsorted(rows[item], np.arange(n), side="right")]
        path = self.finish(bounds, edge, place, item, best, 0, np.zeros(n, np.int64), k)
        out, alive = [(path, np.ones(n, bool), path.log_prob, best)], np.ones(n, bool)
        barred = [np.full((n, 0), -1)]  # edges already taken at the place where a path left an older one
        branch = [np.full(n, -1)]
        for sample in range(1, k + 1):
            value, of, at = self.best_open([p for p, *_ in out])
            alive = alive & (value > -np.inf)
            if sample == k or not alive.any():
                break
            made = self.open_entry(out, barred, branch, value, of, at, alive, sample, k)
            out.append((made, alive, made.log_prob, np.where(alive, value, -np.inf)))
        return out, value

    def finish(self, bounds, edge, place, unit, value, sample, fresh_from, k) -> Paths:
        """Log probabilities along the paths, and the open siblings from ``fresh_from`` on.  Only a row's k largest
        open values can be taken.  Probabilities fall along a path, so siblings are drawn from its fresh part's
        begin on, until k values (and the branch's own, drawn anew later) are above all that the rest can reach."""
        size = np.diff(bounds)
        log_p = self.lat.log_p[edge]
        sums = np.r_[0.0, np.cumsum(log_p)]
        first, later, done, step = bounds[:-1] + fresh_from, size - fresh_from, np.zeros(len(size), np.int64), 64
        open_ = np.full(len(edge), -np.inf)
        rows = np.flatnonzero(later)
        while len(rows):
            count = np.minimum(step, later[rows] - done[rows])
            at, row = _ranges(first[rows] + done[rows], count), np.repeat(rows, count)
            p = np.exp(log_p[at])
            log_rest = np.where(p < 1 - 1e-12, np.log1p(-np.minimum(p, 1 - 1e-12)), -np.inf)
            before = sums[at] - sums[bounds[row]]
            open_[at] = _under(before + log_rest, value[row], self.draw(self.keys[row], sample, 3, place[at]))
            done[rows] += count
            step *= 2
            rows = rows[done[rows] < later[rows]]
            if len(rows):
                drawn = done[rows]
                reach = sums[first[rows] + drawn] - sums[bounds[rows]] + REACH
                above = open_[_ranges(first[rows], drawn)] >= np.repeat(reach, drawn)
                rows = rows[np.add.reduceat(above, np.cumsum(drawn) - drawn, dtype=np.int64) <= k]
        return Paths(bounds, edge, place, unit, sums, open_, sums[bounds[1:]] - sums[bounds[:-1]], first, done)

    def best_open(self, paths: list[Paths]):
        """Per row the largest open value: (value, which path, index in its arrays)."""
        n = len(self.keys)
        value, of, at = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64)
        for i, p in enumerate(paths):
            p.look()
            better = np.flatnonzero(p.top > value)
            value[better], of[better], at[better] = p.top[better], i, p.where[better]
        return value, of, at

    def open_entry(self, out, barred, branch, value, of, at, alive, sample, k) -> Paths:
        """Take the best open entry of each live row: a new edge at its place, and a fresh path from there on."""
        lat, n = self.lat, len(self.keys)
        node, unit, place, taken = (np.zeros(n, np.int64) for _ in range(4))
        bar = np.full((n, sample), -1)
        heads = []
        for i, (p, *_x) in enumerate(out):
            r = np.flatnonzero(alive & (of == i))
            if not len(r):
                continue
            j = at[r]
            node[r], unit[r], place[r] = np.searchsorted(lat.edges, p.edge[j], side="right") - 1, p.unit[j], p.place[j]
            taken[r] = j - p.bounds[:-1][r]
            p.open[j] = -np.inf
            p.changed = r
            again = branch[i][r] == taken[r]  # the entry stands where that path itself branched off
            w = barred[i].shape[1]
            bar[r[again], :w] = barred[i][r[again]]
            bar[r, w if w < sample else sample - 1] = p.edge[j]
            heads.append((r, p))
        r = np.flatnonzero(alive)
        # the new edge, by probability among those not barred
        first, degree = lat.edges[node[r]], lat.edges[node[r] + 1] - lat.edges[node[r]]
        width = int(degree.max(initial=0))
        e = first[:, None] + np.arange(width)
        ok = np.arange(width) < degree[:, None]
        p = np.where(ok, np.exp(lat.log_p[np.minimum(e, len(lat.log_p) - 1)]), 0.0)
        for c in range(bar.shape[1]):
            p[e == bar[r, c][:, None]] = 0.0
        sums = np.cumsum(p, axis=1)
        u = self.draw(self.keys[r], sample, 4, place[r]) * sums[:, -1]
        pick = np.minimum((sums <= u[:, None]).sum(1), width - 1)
        chosen = first + pick
        rest = sums[:, -1] - p[np.arange(len(r)), pick]
        left = ((p > 0) & (np.arange(width) != pick[:, None])).any(1)
        # fresh walks: the rest of the unit, then the row's later units
        later = self.row_end[r] - unit[r]
        walk_unit = _ranges(unit[r], later)
        walk_row = np.repeat(r, later)
        walk_node = lat.first[self.units[walk_unit]]
        walk_node[np.r_[0, np.cumsum(later)[:-1]]] = lat.stop[chosen]
        item, edge, where = self.walk(walk_row, walk_unit, walk_node, sample)
        # older path up to its place, new edge, fresh walk, one after the other
        walked = np.bincount(walk_row[item], minlength=n)
        size = walked.copy()
        size[r] += taken[r] + 1
        bounds = np.r_[0, np.cumsum(size)]
        edges, places, units = (np.empty(int(bounds[-1]), np.int64) for _ in range(3))
        for rows, p in heads:
            to, head = _ranges(bounds[rows], taken[rows]), _ranges(p.bounds[rows], taken[rows])
            edges[to], places[to], units[to] = p.edge[head], p.place[head], p.unit[head]
        to = bounds[r] + taken[r]
        edges[to], places[to], units[to] = chosen, place[r], unit[r]
        to = _ranges(to + 1, walked[r])
        edges[to], places[to], units[to] = edge, where, walk_unit[item]
        fresh = np.zeros(n, np.int64)
        fresh[r] = taken[r]
        made = self.finish(bounds, edges, places, units, value, sample, fresh, k)
        # at the branch itself, all edges taken so far are out
        j = bounds[:-1][r] + taken[r]
        with np.errstate(divide="ignore"):
            location = np.where(left, made.sums[j] - made.sums[bounds[r]] + np.log(np.maximum(rest, 1e-300)), -np.inf)
        made.open[j] = _under(location, value[r], self.draw(self.keys[r], sample, 5, place[r]))
        barred.append(bar)
        spot = np.full(n, -1)
        spot[r] = taken[r]
        branch.append(spot)
        return made


def sample_slice(texts: list[str], keys: np.ndarray, k: int, voc: Vocabulary):
    """Per sample: (ids, bounds, rows that have it, log probability, perturbed value, log inclusion)."""
    search = Search([voc.words(t) for t in texts], keys, voc)
    found, bound = search.top(k)
    out = []
    for path, alive, log_prob, value in found:
        piece = search.lat.piece[path.edge]
        bounds = path.bounds
        if (bare := np.flatnonzero(piece < 0)).size:  # byte pieces in place of each character without a piece
            letters, of = np.unique(piece[bare], return_inverse=True)
            spelled = [voc.byte_ids[list(chr(-1 - c).encode())] for c in letters.tolist()]
            width = np.fromiter(map(len, spelled), np.int64, len(spelled))
            size = np.ones(len(piece), np.int64)
            size[bare] = width[of]
            ids = np.repeat(piece, size)
            starts = np.cumsum(size) - size
            ids[_ranges(starts[bare], size[bare])] = np.concatenate(spelled)[_ranges((np.cumsum(width) - width)[of], width[of])]
            bounds = np.r_[0, np.cumsum(size)][bounds]
            piece = ids
        far = np.minimum(np.where(np.isneginf(bound), 700, log_prob - bound), 700)
        with np.errstate(divide="ignore"):
            inclusion = np.where(far < -30, far, np.log(-np.expm1(-np.exp(np.maximum(far, -40)))))
        out.append((piece, bounds, alive, log_prob, value, inclusion))
    return out


def row_keys(ids: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(str(i), seed) for i in ids], np.uint64)


SAMPLES = "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def encode_samples(df: DataFrame, path: str, k: int = 4, seed: int = 17, decoded: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to ``k`` rows per input row, best first: id, sample (from 1), ids, log_prob, perturbed, log_inclusion;
    with ``decoded`` also the text that the ids decode to."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for part, texts in text_slices(batches, limit=SLICE):
            keys = row_keys(part.column(0).to_pylist(), seed)
            for number, (ids, bounds, alive, log_prob, value, inclusion) in enumerate(
                    sample_slice(texts, keys, k, voc), 1):
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                columns = {id_col: part.column(0), "sample": pa.array(np.full(len(texts), number, np.int32)),
                           "ids": lists, "log_prob": pa.array(log_prob), "perturbed": pa.array(value),
                           "log_inclusion": pa.array(inclusion)}
                if decoded:
                    columns["decoded"] = voc.decode_many(ids, bounds)
                batch = pa.RecordBatch.from_pydict(columns)
                yield batch if alive.all() else batch.filter(pa.array(alive))

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, {SAMPLES}" + ", decoded string" * decoded)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each segmentation; NULL ids give NULL."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in batches:
            texts = [None if ids is None else voc.decode(ids) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, text_col])

    at = df.columns.index(ids_col)
    return df.mapInArrow(run, df.selectExpr("*", f"cast(null as string) as `{text_col}`").schema)
