"""Distinct sampled SentencePiece segmentations: perturbed A-star over the piece lattice.

A text's lattice has a node per character and an edge per vocabulary piece
that stands there; an edge's weight falls with the piece's rank in the
vocabulary, ``-alpha * log(rank)``, and a segmentation's probability is the
product of its edges over the sum of all. No piece spans the start of a
``▁`` run or a line feed, so the lattice factors into words, each built once.

Sampling without replacement adds Gumbel noise to every segmentation's log
probability and takes the largest sums. The search holds branches of the
lattice, each with the maximum of the noisy sums inside (a Gumbel at the
branch's log mass, truncated at its parent's). The best branch is walked to
the one segmentation that attains its maximum; the edges not taken on the
way become new branches. The first ``samples`` maxima are the sample; the next
one, kappa, gives each its inclusion score ``1 - exp(-exp(logp - kappa))``.

A random draw is a hash of the row key and the draw's place, so results do
not depend on batches, partitions or retries. The largest standard Gumbel
draw is bounded (52-bit uniforms), so branches whose log mass lies that far
below the branches already known cannot win and are not drawn.

Characters without a piece, and a literal ``▁``, are spelt in byte pieces, so
decoding gives back every text exactly. Defined results: null and empty texts
have one empty segmentation with score 1; a text with fewer segmentations
than ``samples`` gives them all, each with score 1; rows with equal keys and
texts get equal samples; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

from mailsift.llm._store import give_back, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SAMPLES = 2
SEED = 20
SPACE, LITERAL = "▁", "\ud800"   # word start; stand-in for a literal word-start sign
CHARS_NUMBERED = 1 << 20              # texts whose words are looked up together
EDGES_MOVED = 1 << 16                 # edges that move together when words are forgotten
WORDS_ADDED = 1 << 13                 # new words whose lattices are built together
CHARS_AT_ONCE = 1 << 18               # texts that are sampled together
WORDS_KEPT = 100_000                  # word lattices kept by a worker before the less used half goes
FAR = 36.8                            # -log(2**-53): no Gumbel draw is larger
FIRST_STEPS = 512
_TRIE = np.uint64(0x9E3779B97F4A7C15)


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(length, dtype=length.dtype)
    out = np.repeat(begin - ends + length, length)
    out += np.arange(len(out), dtype=out.dtype)
    return out


class Vocabulary:
    """Pieces of a model file as a trie over characters."""

    def __init__(self, proto: bytes, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i)
                                             or sp.is_unknown(i) or sp.is_unused(i))]
        self._fill({sp.id_to_piece(i): i for i in plain},
                   {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)},
                   n, alpha)

    @classmethod
    def of(cls, pieces: dict[str, int], byte_ids: dict[int, int], size: int, alpha: float):
        self = cls.__new__(cls)
        self._fill(pieces, byte_ids, size, alpha)
        return self

    def _fill(self, pieces, byte_ids, size, alpha):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.byte_id_of = np.array([byte_ids[b] for b in range(0x80)] + [-1], np.int64)
        order = sorted(pieces.values())
        rank = {i: r + 2 for r, i in enumerate(order)}
        self.log_weight = np.full(size, -alpha * np.log(len(order) + 2.0))
        for i, r in rank.items():
            self.log_weight[i] = -alpha * np.log(r)
        self.byte_weight = -alpha * np.log(len(order) + 2.0)
        nodes, goto, ends = {"": 0}, {}, {}
        for piece, i in pieces.items():
            for k in range(1, len(piece) + 1):
                head = piece[:k]
                if head not in nodes:
                    nodes[head] = len(nodes)
                    goto[nodes[head[:-1]] << 21 | ord(head[-1])] = nodes[head]
            ends[nodes[piece]] = i
        # Children by a hash of node and character, the next free slot if it is taken.
        bits = (4 * len(goto) + 16).bit_length()
        self.shift = np.uint64(64 - bits)
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for key, slot in zip(goto, self._slots(np.array([*goto], np.int64)).tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.next[slot] = key, goto[key]
        # From the root by the character itself: every place of every word starts there.
        self.root = np.full(max((k for k in goto if k < 1 << 21), default=0) + 2, -1, np.int64)
        for k in (k for k in goto if k < 1 << 21):
            self.root[k] = goto[k]
        self.piece_at = np.full(len(nodes), -1, np.int64)
        for node, i in ends.items():
            self.piece_at[node] = i
        spelt = [b""] * size
        for piece, i in pieces.items():
            spelt[i] = piece.replace(SPACE, " ").encode()
        for byte, i in byte_ids.items():
            spelt[i] = bytes([byte])
        self.spelt = pa.array(spelt, pa.large_binary())

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _TRIE) >> self.shift).view(np.int64)

    def child(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``node << 21 | character`` lead on, and to which nodes."""
        slot = self._slots(keys)
        found = self.keys[slot]
        other = np.flatnonzero(found != keys)
        other = other[found[other] >= 0]
        while len(other):
            at = (slot[other] + 1) & (len(self.keys) - 1)
            slot[other], found[other] = at, self.keys[at]
            other = other[(found[other] != keys[other]) & (found[other] >= 0)]
        on = np.flatnonzero(found == keys)
        return on, self.next[slot[on]]

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """UTF-8 of the pieces one after the other, and where each begins (and the last ends)."""
        _, ends, text = self.spelt.take(pa.array(ids)).buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1)
        return text.slice(0, int(ends[-1])).to_pybytes() if text else b"", ends

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that the ids spell, without the leading dummy space."""
        return self.spell(ids)[0][1:]


def _words(texts: list[str | None]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, numbered by kind, and where each text's words begin and end.

    Words are as in ``_normalised``, spelt as in the text: a dummy space comes first, and a
    word begins with a run of spaces, at a line feed (a word of its own) and behind it.
    """
    raw = [b" " + t.encode() if t else b"" for t in texts]
    cuts = np.cumsum([0, *map(len, raw)])
    blob = b"".join(raw)
    chars = np.frombuffer(blob, np.uint8)
    space, line, first = chars == 32, chars == 10, np.ones(len(chars), bool)
    first[1:] = (space[1:] > space[:-1]) | line[1:] | line[:-1]
    first[cuts[:-1][cuts[:-1] < cuts[1:]]] = True
    at = np.flatnonzero(first)
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(chars))),
                                             pa.py_buffer(blob))
    return words.dictionary_encode(), np.searchsorted(at, cuts)


def _halves(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Views of the links' cumulative probabilities and next edges."""
    return link.view(np.float32)[::2], link.view(np.int32)[1::2]


class Lattices:
    """Edges of word lattices, words appended as they come.

    Edge arrays: link, piece id (or -2 - character for byte spelling), log conditional
    probability, and the word's number. A link holds two halves, read in one step: the
    cumulative conditional probability inside the node (2 at its last edge), and the
    first edge of the next node (-1 at the word's end). Word arrays, by the words'
    numbers: first edge and how often the word came. Nodes of words that came together
    lie by their distance from the word's end.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.words = vocabulary, {}
        self.n_words = self.n_edges = 0
        self.begin, self.uses = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int64)
        self.link, self.logp = np.zeros(1 << 13, np.int64), np.zeros(1 << 13)
        self.piece, self.owner = np.zeros(1 << 13, np.int32), np.zeros(1 << 13, np.int32)

    @property
    def to(self) -> np.ndarray:
        return _halves(self.link)[1]

    @property
    def cum(self) -> np.ndarray:
        return _halves(self.link)[0]

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        wider = np.zeros(max(size, len(array) * 3 // 2), array.dtype)
        wider[:len(array)] = array
        return wider

    def starts(self, words: pa.DictionaryArray) -> np.ndarray:
        """First edge of each word, building the lattices of new words together."""
        known, kinds = self.words, words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(known.get, kinds, repeat(-1)), np.int64, len(kinds))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new = [kinds[i] for i in missing.tolist()]
            numbers[missing] = np.arange(len(known), len(known) + len(new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            if SPACE in "".join(new):
                new = [w.replace(SPACE, LITERAL) for w in new]
            for i in range(0, len(new), WORDS_ADDED):
                self._add([w.replace(" ", SPACE) for w in new[i:i + WORDS_ADDED]])
        which = words.indices.to_numpy()
        self.uses = self._room(self.uses, len(known))
        self.uses[numbers] += np.bincount(which, minlength=len(kinds))
        return self.begin[numbers][which]

    def forget(self, keep: int) -> None:
        """Keep the lattices of the ``keep`` most used words alone, in the same arrays.

        The counts of those kept are halved, so that words that come no more go in the end.
        """
        n, m = len(self.words), self.n_edges
        kept = np.sort(np.argsort(-self.uses[:n], kind="stable")[:keep])
        number = np.full(n, -1, np.int32)
        number[kept] = np.arange(len(kept))
        place = np.cumsum((number >= 0)[self.owner[:m]], dtype=np.int32)
        place -= 1
        end = 0
        for a in range(0, m, EDGES_MOVED):  # downwards, so none is overwritten before it moves
            owner = number[self.owner[a:min(a + EDGES_MOVED, m)]]
            edge = np.flatnonzero(owner >= 0)
            begin, end = end, end + len(edge)
            self.owner[begin:end] = owner[edge]
            edge += a
            for array in (self.link, self.piece, self.logp):
                array[begin:end] = array[edge]
            to = self.to[begin:end]
            to[:] = np.where(to < 0, np.int32(-1), place[to])
        self.n_words, self.n_edges = len(kept), end
        words = list(self.words)
        self.words = {words[k]: i for i, k in enumerate(kept.tolist())}
        self.begin[:len(kept)], self.uses[:len(kept)] = place[self.begin[kept]], self.uses[kept] // 2
        self.uses[len(kept):] = 0

    def _edges(self, chars: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges ``(to, piece, weight)`` by place and length, and how many each place has.

        ``after`` is the next place of the word, the number of places at its end.
        """
        v, n = self.v, len(chars)
        # Walk the trie from every place at once; places drop out as they leave it.
        state = v.root[np.minimum(chars, len(v.root) - 1)]
        live = np.flatnonzero(state >= 0)
        state, to, found = state[live], after[live], []
        while len(live):
            piece = v.piece_at[state]
            here = np.flatnonzero(piece >= 0)
            found.append((live[here], to[here], piece[here]))
            more = np.flatnonzero(to < n)
            live, to = live[more], to[more]
            on, state = v.child(state[more] << 21 | chars[to])
            live, to = live[on], after[to[on]]
        alone = np.ones(n, bool)  # a character without a piece is spelt in bytes
        if found:
            alone[found[0][0]] = False
        alone = np.flatnonzero(alone)
        one_byte = v.byte_id_of[np.minimum(chars[alone], 0x80)]
        found.insert(0, (alone, after[alone], np.where(one_byte >= 0, one_byte, -2 - chars[alone])))
        per = np.zeros(n, np.int64)
        for at, *_ in found:
            per[at] += 1
        put = np.cumsum(per) - per
        size = int(per.sum())
        to, pid = np.empty(size, np.int64), np.empty(size, np.int64)
        for at, ends, ids in found:  # one edge for each place and depth, shortest first
            k = put[at]
            to[k], pid[k] = ends, ids
            put[at] += 1
        weight = v.log_weight.take(pid, mode="clip")
        spelt = np.flatnonzero(pid < 0)
        code = -2 - pid[spelt]
        weight[spelt] = v.byte_weight * np.select([code < 0x80, code < 0x800, code < 0x10000],
                                                  [1, 2, 3], 4)
        return to, pid, weight, per

    def _add(self, new: list[str]) -> None:
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        chars = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32)
        # Places equally far from their word's end lie together, the longest words first.
        order = np.argsort(-lengths, kind="stable")
        far = np.arange(1, int(lengths.max()) + 1)
        wide = np.searchsorted(-lengths[order], -far, side="right")
        cuts = np.concatenate(([0], np.cumsum(wide)))
        rank = _ranges(np.zeros(len(wide), np.int64), wide)
        chars = chars[np.cumsum(lengths)[order][rank] - np.repeat(far, wide)].astype(np.int64)
        n = len(chars)
        after = np.arange(n) - np.repeat(np.concatenate(([0], wide[:-1])), wide)
        after[:len(new)] = n
        to, pid, weight, per = self._edges(chars, after)
        # Log mass below each place, from the words' ends on.
        ends = np.concatenate(([0], np.cumsum(per)))
        heads, edge_cuts = ends[:-1], ends[cuts].tolist()
        below, cuts = np.zeros(n + 1), cuts.tolist()
        for i, j, a, b in zip(cuts, cuts[1:], edge_cuts, edge_cuts[1:]):
            score, first = weight[a:b], heads[i:j] - a
            score += below[to[a:b]]
            top = score[first]
            if b > a and float(score.max() - top.min()) > 600:  # else no sum overflows
                top = np.maximum.reduceat(score, first)
            mass = np.add.reduceat(np.exp(score - np.repeat(top, per[i:j])), first)
            below[i:j] = top + np.log(mass)
        logp = np.minimum(weight - np.repeat(below[:n], per), 0.0)
        prob = np.exp(logp)
        run = np.cumsum(prob)
        cum = run - np.repeat(run[heads] - prob[heads], per)
        cum[ends[1:] - 1] = 2.0  # the last edge takes what is left
        size = self.n_edges + len(to)
        link = np.empty(len(to), np.int64)
        half, after = _halves(link)
        half[:], after[:] = cum, np.where(to == n, -1, ends[to] + self.n_edges)
        for name, values in (("link", link), ("piece", pid), ("logp", logp),
                             ("owner", np.repeat(order[rank] + self.n_words, per))):
            array = self._room(getattr(self, name), size)
            array[self.n_edges:size] = values
            setattr(self, name, array)
        self.begin = self._room(self.begin, self.n_words + len(new))
        self.begin[self.n_words + order] = heads[np.array(cuts)[lengths[order] - 1]
                                                 + np.arange(len(new))] + self.n_edges
        self.n_words, self.n_edges = self.n_words + len(new), size


def _mix(x: np.ndarray) -> np.ndarray:
    """Uniforms in (0, 1) from 64-bit counters."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    part = x >> np.uint64(30)
    x ^= part
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=part)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=part)
    x >>= np.uint64(12)
    u = x.astype(np.float64)
    u += 0.5
    u *= 2.0 ** -52
    return u


_ALL = 2 ** 64 - 1
_PLACE, _STEP, _STREAM = (np.uint64(k) for k in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5,
                                                 0x2545F4914F6CDD1D))


def _draw(seed, place, step, stream) -> np.ndarray:
    """``seed`` per row key; ``place``, ``step`` and ``stream`` say which draw it is."""
    which = (step * int(_STEP) + stream * int(_STREAM)) & _ALL
    return _mix(np.atleast_1d(seed) + place.astype(np.uint64) * _PLACE + np.uint64(which))


def _draw_one(seed: int, place: int, step: int, stream: int) -> float:
    """One draw of ``_draw``, in Python's integers."""
    x = seed + place * int(_PLACE) + step * int(_STEP) + stream * int(_STREAM) + 0x9E3779B97F4A7C15
    x &= _ALL
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _ALL
    x ^= x >> 31
    return ((x >> 12) + 0.5) * 2.0 ** -52


def _walk(lat: Lattices, start: np.ndarray, seed: np.ndarray, place: np.ndarray,
          stream: int) -> tuple[np.ndarray, np.ndarray]:
    """Sample each word from its first node on; edges in word order, and how many each has."""
    edge, live = start.astype(np.int64), np.arange(len(start))
    key = seed + place.astype(np.uint64) * _PLACE  # as in _draw
    counts, waves, step = np.zeros(len(start), np.int64), [], 0
    while len(live):
        u = _mix(key + np.uint64((step * int(_STEP) + stream * int(_STREAM)) & _ALL))
        link = lat.link[edge]
        behind = np.flatnonzero(_halves(link)[0] <= u)
        while len(behind):
            on = edge[behind] + 1
            edge[behind] = on
            link[behind] = on = lat.link[on]
            behind = behind[_halves(on)[0] <= u[behind]]
        waves.append((live, edge))
        after = _halves(link)[1]
        on = np.flatnonzero(after >= 0)
        counts[live] += 1
        edge, live, key = after[on].astype(np.int64), live[on], key[on]
        step += 1
    out = np.empty(int(counts.sum()), np.int64)
    head = np.cumsum(counts) - counts
    for who, edge in waves:
        out[head[who]] = edge
        head[who] += 1
    return out, counts


class _Search:
    """The branches of one text, best first; paths hold edges, and words by step."""

    def __init__(self, lat: Lattices, start: np.ndarray, seed: int, samples: int):
        self.lat, self.start, self.seed, self.samples = lat, start, np.uint64(seed), samples
        self.paths, self.heap, self.count = [], [], 0

    def add(self, edges: np.ndarray, words: np.ndarray, logp: np.ndarray, top: float) -> int:
        """Keep a finished path with maximum ``top``; returns how many branches it may leave."""
        self.paths.append((edges, words, top, logp))
        return self.samples + 1 - len(self.paths)

    def offer(self, best: np.ndarray, prefix: np.ndarray, fresh: int, ends: float,
              whole: bool) -> bool:
        """Take the best of the last path's branches from step ``fresh`` on.

        False if steps that were not drawn (log mass up to ``ends``) might still win.
        """
        need = self.samples + 1 - len(self.paths)
        path = len(self.paths) - 1
        rest, keep = best.copy(), []
        while len(rest) and len(keep) < need:  # few: no sorting
            at = int(rest.argmax())
            if rest[at] == -np.inf:
                break
            keep.append(at)
            rest[at] = -np.inf
        known = sorted(best[keep].tolist() + [-h[0] for h in self.heap], reverse=True)
        if not whole and (len(known) < need or known[need - 1] <= ends + FAR):
            return False
        edges = self.paths[path][0]
        for k in keep:
            self.push(float(best[k]), path, fresh + k, (int(edges[fresh + k]),), float(prefix[k]))
        return True

    def push(self, best: float, path: int, step: int, taken: tuple, prefix: float) -> None:
        heapq.heappush(self.heap, (-best, self.count, path, step, taken, prefix))
        self.count += 1

    def pop(self) -> tuple | None:
        """Branch off the best open branch: (path, step, edge, maximum)."""
        if not self.heap:
            return None
        lat = self.lat
        best, _, path, step, taken, prefix = heapq.heappop(self.heap)
        best = -best
        edges, words = self.paths[path][:2]
        inside = step > 0 and words[step - 1] == words[step]
        whole, after = _halves(lat.link)
        edge = int(after[edges[step - 1]] if inside else self.start[words[step]])
        node = [edge]
        while whole[node[-1]] < 2:
            node.append(node[-1] + 1)
        rest = [e for e in node if e not in taken]
        prob = [math.exp(lat.logp[e]) for e in rest]
        place, seed, whole = step + (path << 32), int(self.seed), sum(prob)
        u, at, run = _draw_one(seed, place, 7, 2000 + len(taken)) * whole, 0, prob[0]
        while run < u and at + 1 < len(rest):
            at += 1
            run += prob[at]
        edge, others = rest[at], whole - prob[at]
        if len(rest) > 1 and others > 0:
            noise = math.log(-math.log(_draw_one(seed, place, 7, 3000 + len(taken))))
            self.push(float(-np.logaddexp(-best, noise - prefix - math.log(others))),
                      path, step, (*taken, edge), prefix)
        return path, step, edge, best


def _branch(searches: list[_Search], fresh: list[int], logps: list[np.ndarray]) -> None:
    """Draw the maxima of the branches that the searches' last paths leave.

    All searches together over their first steps; those where a later step
    might still win are drawn again over more.
    """
    todo, steps = list(range(len(searches))), FIRST_STEPS
    while todo:
        sizes = [min(steps, len(logps[i]) - fresh[i]) for i in todo]
        part = np.concatenate([logps[i][fresh[i]:fresh[i] + n] for i, n in zip(todo, sizes)])
        cuts = np.cumsum([0] + sizes)
        before = np.array([logps[i][:fresh[i]].sum() for i in todo])
        run = np.cumsum(part)
        zero = np.concatenate(([0.0], run))[cuts[:-1]]
        prefix = run - part + np.repeat(before - zero, sizes)
        seed = np.repeat(np.array([searches[i].seed for i in todo], np.uint64), sizes)
        path = np.repeat([len(searches[i].paths) - 1 for i in todo], sizes)
        place = np.arange(len(part)) + np.repeat(np.array([fresh[i] for i in todo]) - cuts[:-1],
                                                 sizes) + (path << 32)
        top = np.repeat([searches[i].paths[-1][2] for i in todo], sizes)
        with np.errstate(divide="ignore"):
            mass = prefix + np.log(-np.expm1(part))  # -inf where nothing else stands
        best = -np.logaddexp(-top, np.log(-np.log(_draw(seed, place, 7, 1000))) - mass)
        again = []
        for i, a, b in zip(todo, cuts[:-1].tolist(), cuts[1:].tolist()):
            ends = float(prefix[b - 1] + part[b - 1]) if b > a else -np.inf
            if not searches[i].offer(best[a:b], prefix[a:b], fresh[i], ends,
                                     fresh[i] + b - a == len(logps[i])):
                again.append(i)
        todo, steps = again, steps * 8


def _normalised(text: str | None) -> str:
    return SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE) if text else ""


def _ids(lat: Lattices, edges: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of paths with these ends; characters spelt in several bytes are put in place."""
    pieces = lat.piece[edges]
    spelt = np.flatnonzero(pieces < 0)
    if not len(spelt):
        return pieces, ends
    codes, kind = np.unique(pieces[spelt], return_inverse=True)
    by, chars = lat.v.byte_ids, [chr(-2 - p) for p in codes.tolist()]
    runs = [[by[b] for b in (SPACE if c == LITERAL else c).encode()] for c in chars]
    width = np.array([len(r) for r in runs])
    counts = np.ones(len(pieces), np.int64)
    counts[spelt] = width[kind]
    out = np.repeat(pieces, counts)
    out[out < 0] = np.array(sum(runs, []))[_ranges((np.cumsum(width) - width)[kind], width[kind])]
    return out, np.concatenate(([0], np.cumsum(counts)))[ends]


def _walked(lat: Lattices, starts: np.ndarray, bounds: np.ndarray, seeds: list[int],
            samples: int) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """``(row, nth, log probability, perturbed, inclusion)`` of all samples, their ids and their ends."""
    n_words, seed = np.diff(bounds), np.array(seeds, np.uint64)
    searches = [_Search(lat, starts[a:b], s, samples)
                for a, b, s in zip(bounds[:-1].tolist(), bounds[1:].tolist(), seeds)]
    # What is to be walked next in each search: (branch or None, first whole word)
    todo = []
    for i, s in enumerate(searches):
        u = _draw_one(int(s.seed), 0, 3, 99)
        todo.append((i, None, 0, -math.log(-math.log(u))))
    for nth in range(samples):
        if not todo:
            break
        who, word = np.array([t[0] for t in todo]), np.array([t[2] for t in todo])
        inside = lat.to[[t[1][2] for t in todo]].astype(np.int64) if nth else np.full(len(who), -1)
        part = inside >= 0  # first the rest of the word that the branch stands in
        spans = n_words[who] - word + part
        place = _ranges(word - part, spans)
        start = starts[place + np.repeat(bounds[who], spans)]
        start[(np.cumsum(spans) - spans)[part]] = inside[part]
        edges, counts = _walk(lat, start, np.repeat(seed[who], spans), place, nth)
        owner, all_logp = np.repeat(place, counts), lat.logp[edges]
        edge_cuts = np.concatenate(([0], np.cumsum(counts)))[np.cumsum([0, *spans])].tolist()
        ended, fresh, logps = [], [], []
        for (i, branch, _, top), a, b in zip(todo, edge_cuts[:-1], edge_cuts[1:]):
            s, new, own, logp, step = searches[i], edges[a:b], owner[a:b], all_logp[a:b], -1
            if branch:
                path, step, edge, _ = branch
                old, at, _, old_logp = s.paths[path]
                new = np.concatenate((old[:step], [edge], new))
                own = np.concatenate((at[:step + 1], own))
                logp = np.concatenate((old_logp[:step], [lat.logp[edge]], logp))
            if s.add(new, own, logp, top) > 0:
                ended.append(s)
                fresh.append(step + 1)
                logps.append(logp)
        _branch(ended, fresh, logps)
        if nth + 1 < samples:
            todo = []
            for i, s in enumerate(searches):
                branch = s.pop()
                if branch:
                    todo.append((i, branch, int(s.paths[branch[0]][1][branch[1]]) + 1, branch[3]))
    rows, paths = [], []
    for i, s in enumerate(searches):
        kappa = -s.heap[0][0] if s.heap else -np.inf
        for nth, (edges, _, top, logp) in enumerate(s.paths):
            logp = float(logp.sum())
            with np.errstate(over="ignore"):
                score = float(-np.expm1(-np.exp(logp - kappa)))
            rows.append((i, nth + 1, logp, float(top), score))
            paths.append(edges)
    if not paths:
        return [], np.zeros(0, np.int32), np.zeros(0, np.int64)
    return rows, *_ids(lat, np.concatenate(paths), np.cumsum([len(p) for p in paths]))


def _sampled(lat: Lattices, texts: list[str | None], seeds: list[int],
             samples: int) -> Iterator[tuple[int, int, list[tuple], np.ndarray, np.ndarray]]:
    """What ``_walked`` gives for parts of the texts, from and to which text first."""
    words, bounds = _words(texts)
    if len(lat.words) > WORDS_KEPT:
        lat.forget(WORDS_KEPT // 2)
    starts = lat.starts(words)
    del words
    for a, b in _parts(texts, CHARS_AT_ONCE):
        yield a, b, *_walked(lat, starts[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a],
                             seeds[a:b], samples)


def sample_batch(lat: Lattices, texts: list[str | None], seeds: list[int],
                 samples: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """Yield ``(row, nth, ids, log probability, perturbed, inclusion)`` for each text."""
    for at, _, rows, ids, ends in _sampled(lat, texts, seeds, samples):
        for (i, nth, *numbers), a, b in zip(rows, [0, *ends.tolist()], ends.tolist()):
            yield at + i, nth, ids[a:b], *numbers


_LATTICES: dict = {}


def _lattices(proto: bytes, alpha: float) -> Lattices:
    """The worker's lattices, kept from batch to batch."""
    key = (xxhash.xxh64_intdigest(proto), alpha)
    if key not in _LATTICES:
        _LATTICES[key] = Lattices(Vocabulary(proto, alpha))
    return _LATTICES[key]


def _parts(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > chars:
            yield at, i
            at, size = i, 0
        size += len(t or "") + 1
    if at < len(texts):
        yield at, len(texts)


def _table(v: Vocabulary, keys: pa.Array, texts: list[str | None], rows: list[tuple],
           ids: np.ndarray, ends: np.ndarray, schema: pa.Schema, with_ids: bool) -> pa.RecordBatch:
    """The samples of some texts as rows of ``sample_segmentations``."""
    which, nth, logp, top, score = zip(*rows)
    ids, ends = np.ascontiguousarray(ids, "<i4"), np.append(0, ends)
    spelt, at = v.spell(ids)
    whole, cuts = [(t or "").encode() for t in texts], at[ends].tolist()
    back = [spelt[a + 1:b] == whole[i] for i, a, b in zip(which, cuts, cuts[1:])]
    crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
    values = (nth, np.diff(ends), logp, top, score, crc, back)
    columns = [keys.take(pa.array(which, pa.int64()))]
    columns += [pa.array(c, f.type) for c, f in zip(values, list(schema)[1:])]
    if with_ids:  # one array of all ids and where each list begins
        columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids),
                                                type=schema[-1].type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def sample_segmentations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         samples: int = SAMPLES, alpha: float = ALPHA, model: str = MODEL,
                         seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """One row per text and sampled segmentation; narrow, whole texts.

    Columns: the id, ``sample`` (from 1, best perturbed first), ``n_pieces``,
    ``log_prob``, ``perturbed``, ``inclusion``, ``ids_crc32`` (of the little-endian
    32-bit ids), ``round_trip`` (the ids decode to the text) and, if asked for,
    ``ids``. The model file is read on the driver and shipped with the tasks.
    """
    small_batches(docs.sparkSession)
    proto = Path(model).read_bytes()
    fields = [StructField(id_col, docs.schema[id_col].dataType),
              StructField("sample", IntegerType()), StructField("n_pieces", LongType()),
              StructField("log_prob", DoubleType()), StructField("perturbed", DoubleType()),
              StructField("inclusion", DoubleType()), StructField("ids_crc32", LongType()),
              StructField("round_trip", BooleanType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    out_schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out_schema)
        for batch in batches:
            keys, seeds = batch.column(0), batch.column(2).to_pylist()
            texts = batch.column(1).to_pylist()
            lat = _lattices(proto, alpha)
            for a, b in _parts(texts, CHARS_NUMBERED):
                for i, j, *found in _sampled(lat, texts[a:b], seeds[a:b], samples):
                    yield _table(lat.v, keys.slice(a + i, j - i), texts[a + i:a + j], *found, schema,
                                 with_ids)
        batch = texts = keys = seeds = lat = found = None
        for key, lat in _LATTICES.items():  # an idle worker keeps the vocabulary alone
            _LATTICES[key] = Lattices(lat.v)
        give_back()

    key = F.xxhash64(F.lit(seed), F.col(id_col))
    ready = docs.select(F.col(id_col), F.col(text_col),
                        F.shiftrightunsigned(key, 1).alias("row_key"))
    return ready.mapInArrow(run, out_schema)


def decode_ids(df: DataFrame, ids_col: str = "ids", out_col: str = "text",
               model: str = MODEL) -> DataFrame:
    """Add the text that the ids spell (null ids: null); the inverse of every sample."""
    proto = Path(model).read_bytes()

    @F.arrow_udf(StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _lattices(proto, ALPHA).v
        for batch in batches:
            yield pa.array([None if ids is None else vocabulary.decode(
                np.array(ids, np.int64)).decode() for ids in batch.to_pylist()], pa.string())
    return df.withColumn(out_col, of(F.col(ids_col)))
