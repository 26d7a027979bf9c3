"""SentencePiece encoding and decoding with the N best segmentations.

The pieces of the model that match at each place of a text form a lattice. A forward Viterbi
pass gives for every place the best score of any way to reach it. A backward A-star search
starts at the end of the text; a partial segmentation is ranked by its own score plus the
forward score of the place where it begins, which is exactly the best that can still be added.
So complete segmentations come out best first, and no more is looked at than needed.

The score of a segmentation is the sum of its pieces' scores in the model file. A character
without a piece becomes its UTF-8 bytes, all together scored as an unknown: the least score
less 10.

Where no piece has the mark of a space after another character, which is checked on loading,
every space begins a new part of the lattice that no piece crosses. The best ways of a part are
found by the two passes above.
The N best of the text come from the same search over the chain of parts: the best takes every
part's best, and the N best change at most N - 1 parts, which are among the N - 1 whose second
way loses least. Within a part the lattice falls apart once more wherever no piece holds two
neighbouring characters side by side; the best between two such places and the loss of the second
are remembered by a worker, within a bound of bytes. A model with other pieces is searched over its whole lattice.

Equal scores come in the order in which the search meets them: what was met last goes on first,
and between parts the later part changes first. Texts keep all characters: the decoder turns marks
back into spaces, bytes into characters and drops the prefix space. The literal mark of a space
in a text cannot be told from a space and decodes to one. Null and empty texts have one
segmentation without pieces.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from opsreport.llm.common import record, struct_column, text_or_empty

MARK = "▁"
N_BEST = 4
#: Bytes of pieces of parts between safe places that a worker remembers, at most twice; about
#: what an entry takes beside its text and ids.
MEMO = 32 << 20
ENTRY = 330
#: Characters of text whose parts are numbered and looked up together.
TOGETHER = 1 << 21
#: Short parts whose n best ways are remembered.
NEAR = 4096
#: Characters of the longest text between safe places that is searched along with others, and of
#: all that are searched at once.
SHORT = 40
AT_ONCE = 1 << 16
UNKNOWN_PENALTY = 10.0

ENCODED, ENCODED_ARROW = record(
    "n_segmentations long, n_tokens long, score double, ids_crc32 long, next_score double, "
    "n_bytes_fallback long, decodes boolean"
)

_PARTS = re.compile(f"{MARK}+[^{MARK}]*")

Segmentation = tuple[float, tuple[int, ...]]


class Pieces:
    """The vocabulary of a model file, its lattice search and its decoder."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.id: dict[str, int] = {}
        self.score: list[float] = []
        self.piece: list[str] = []
        self.byte = [-1] * 256
        self.byte_of: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.piece.append(piece)
            self.score.append(sp.get_score(i))
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.byte_of[i] = value
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.id[piece] = i
        scores = [self.score[i] for i in self.id.values()]
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = sp.unk_id()
        self.parted = not any(MARK in p.lstrip(MARK) for p in self.id)
        # A trie: for each character what follows, and score and ids if a piece ends there.
        self.openings: dict[str, list] = {}
        for p, i in self.id.items():
            following = self.openings
            for c in p:
                node = following.setdefault(c, [{}, 0.0, None])
                following = node[0]
            node[1], node[2] = self.score[i], (i,)
        # Number of each character of a piece, 0 for all others, and which stand side by side.
        letters = sorted({c for p in self.id for c in p})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.side_by_side = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p in self.id:
            own = self.number[[ord(c) for c in p]]
            self.side_by_side[own[:-1], own[1:]] = True
        self.longest = max(map(len, self.id), default=1)
        self._number_trie(len(letters) + 1)
        self.cuts: dict[str, tuple[float, float, bytes]] = {}
        self.old_cuts: dict[str, tuple[float, float, bytes]] = {}
        self.cut_bytes = 0
        self.near: dict[tuple[str, int], list[Segmentation]] = {}
        # What an id stands for in a text; bytes above 127 as escapes that go back to bytes.
        self.shown = [p.replace(MARK, " ") for p in self.piece]
        self.is_byte = np.zeros(len(self.piece), bool)
        for i, value in self.byte_of.items():
            self.is_byte[i] = True
            self.shown[i] = chr(value) if value < 128 else chr(0xDC00 + value)
        shown = [x.encode("utf-8", "surrogateescape") for x in self.shown]
        self.shown_bytes = pa.array(shown, pa.large_binary())

    def _number_trie(self, letters: int) -> None:
        """The trie as columns: node * letters + letter leads to a node, which may end a piece."""
        step: dict[int, int] = {}
        ends = [(float("-inf"), -1)]
        for p, i in self.id.items():
            node = 0
            for c in self.number[[ord(c) for c in p]].tolist():
                node = step.setdefault(node * letters + c, len(ends))
                if node == len(ends):
                    ends.append((float("-inf"), -1))
            ends[node] = (self.score[i], i)
        self.letters = letters
        self.steps = np.array(sorted(step), np.int64)
        self.leads_to = np.array([step[k] for k in self.steps.tolist()], np.int32)
        self.end_score = np.array([x for x, _ in ends], np.float64)
        self.end_id = np.array([i for _, i in ends], np.int32)
        # Which letters are pieces themselves.
        self.alone = np.zeros(letters, bool)
        for c in (c for c in self.id if len(c) == 1):
            self.alone[self.number[ord(c)]] = True

    # -- the lattice

    def _forward(self, text: str) -> tuple[list[list[tuple]], list[float]]:
        """For each place the pieces (begin, score, ids) that end there, and the best score."""
        size = len(text)
        first, longest = self.openings.get, self.longest
        ends: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        forward = [0.0] + [float("-inf")] * size
        for begin in range(size):
            base = forward[begin]
            end, follows = begin, first
            for c in text[begin : begin + longest]:
                hit = follows(c)
                if hit is None:
                    break
                end += 1
                following, s, one = hit
                if one is not None:
                    ends[end].append((begin, s, one))
                    if base + s > forward[end]:
                        forward[end] = base + s
                follows = following.get
            last = ends[begin + 1]
            if not last or last[-1][0] != begin:
                ends[begin + 1].append((begin, self.unknown, self._fallback(text[begin])))
                forward[begin + 1] = max(forward[begin + 1], base + self.unknown)
        return ends, forward

    def _fallback(self, character: str) -> tuple[int, ...]:
        """Ids of the bytes of a character without a piece."""
        ids = tuple([self.byte[b] for b in character.encode("utf-8", "replace")])
        return ids if min(ids) >= 0 else (self.unknown_id,)

    def n_best(self, text: str, n: int) -> list[Segmentation]:
        """Up to n segmentations of a part, best first."""
        ends, forward = self._forward(text)
        heap: list[tuple[float, int, int, float, tuple[int, ...]]] = []
        heap.append((-forward[-1], 0, len(text), 0.0, ()))
        # No place can be on more than n of the n best ways.
        seen = [0] * len(ends)
        out: list[Segmentation] = []
        pushed = 0
        while heap and len(out) < n:
            _, _, place, own, ids = heapq.heappop(heap)
            if place == 0:
                out.append((own, ids))
                continue
            seen[place] += 1
            if seen[place] > n:
                continue
            for begin, s, piece in ends[place]:
                pushed -= 1
                score = own + s
                heapq.heappush(heap, (-(score + forward[begin]), pushed, begin, score, piece + ids))
        return out

    def best_two(self, text: str) -> tuple[float, float, tuple[int, ...]]:
        """Score and ids of the best, and how much less the second scores.

        The same search where it needs no heap: with an exact heuristic the way to the first
        result never leaves it, and the second is then the best of what was met on the way.
        """
        ends, forward = self._forward(text)
        best, second = forward[-1], float("-inf")
        place, own, ids = len(text), 0.0, ()
        while place:
            top = float("-inf")
            for begin, s, piece in ends[place]:
                rank = own + s + forward[begin]
                if rank >= top:
                    second = max(second, top)
                    top, to, score, taken = rank, begin, s, piece
                elif rank > second:
                    second = rank
            place, own, ids = to, own + score, taken + ids
        return best, best - second, ids

    def _hits(self, known: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece of each length at each place; ``left`` characters follow."""
        score = np.full((self.longest, len(known)), float("-inf"))
        ids = np.full((self.longest, len(known)), -1, np.int32)
        at, node = np.arange(len(known)), np.zeros(len(known), np.int64)
        for k in range(self.longest):
            within = left[at] > k
            at, node = at[within], node[within]
            if not len(at):
                break
            key = node * self.letters + known[at + k]
            to = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[to] == key
            at, node = at[hit], self.leads_to[to[hit]].astype(np.int64)
            score[k, at], ids[k, at] = self.end_score[node], self.end_id[node]
        return score, ids

    def _best_two_of(
        self, known: np.ndarray, sizes: np.ndarray
    ) -> list[tuple[float, float, bytes]]:
        """``best_two`` of many texts whose letters are pieces themselves, one place of all of
        them at a time. The second leaves the best way at one place for the last time, so it
        loses the least of what the second way to a place of the best loses there."""
        order = np.argsort(-sizes, kind="stable")
        starts, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(known))
        score, ids = self._hits(known, left)
        top = int(size[0])
        best = np.zeros((top + 1, len(size)))
        lost, length = np.zeros_like(best), np.zeros(best.shape, np.int32)
        for end in range(1, top + 1):
            n = int(np.searchsorted(-size, -end, side="right"))
            first = np.full(n, float("-inf"))
            second, own = first.copy(), np.zeros(n, np.int32)
            for k in range(min(end, self.longest), 0, -1):
                way = best[end - k, :n] + score[k - 1, starts[:n] + (end - k)]
                taken = way >= first
                second = np.where(taken, first, np.maximum(second, way))
                first = np.where(taken, way, first)
                own[taken] = k
            best[end, :n], lost[end, :n], length[end, :n] = first, first - second, own
        loss, place, on = np.full(len(size), float("inf")), size.copy(), np.arange(len(size))
        way = np.full(len(known), -1, np.int32)
        while len(on):
            end = place[on]
            k = length[end, on]
            loss[on] = np.minimum(loss[on], lost[end, on])
            begin = starts[on] + end - k
            way[begin] = ids[k - 1, begin]
            place[on] = end - k
            on = on[place[on] > 0]
        total, back = best[size, np.arange(len(size))], np.argsort(order)
        data = way[way >= 0].astype("<u4").tobytes()
        ends = 4 * np.cumsum(way >= 0)[np.cumsum(sizes) - 1]
        bounds = [0, *ends.tolist()]
        ways = [data[x:y] for x, y in zip(bounds, bounds[1:])]
        return list(zip(total[back].tolist(), loss[back].tolist(), ways, strict=True))

    def _learnt(self, cuts: list[str]) -> Iterator[tuple[str, tuple[float, float, bytes]]]:
        """Each text between safe places with what is remembered of it."""
        points = np.frombuffer("".join(cuts).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = self.number[points].astype(np.int64)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        starts = np.cumsum(sizes) - sizes
        many = np.logical_and.reduceat(self.alone[known], starts) & (sizes <= SHORT)
        for k in np.flatnonzero(~many).tolist():
            score, second, one = self.best_two(cuts[k])
            yield cuts[k], (score, second, pack(f"<{len(one)}I", *one))
        some = np.flatnonzero(many)
        known, sizes = known[np.repeat(many, sizes)], sizes[some]
        ends = np.cumsum(sizes)
        groups = np.flatnonzero(np.diff((ends - sizes) // AT_ONCE)) + 1
        for rows, own in zip(np.split(some, groups), np.split(sizes, groups), strict=True):
            if len(rows):
                found = self._best_two_of(known[: own.sum()], own)
                known = known[own.sum() :]
                yield from zip([cuts[k] for k in rows.tolist()], found, strict=True)

    def _cut_ends(self, text: str, stops: np.ndarray) -> np.ndarray:
        """Places no piece crosses, as none holds the two characters side by side, and the
        given ones."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        known = self.number[points]
        cut = np.zeros(len(points) + 1, bool)
        cut[1:-1] = ~self.side_by_side[known[:-1], known[1:]]
        cut[stops] = True
        return np.flatnonzero(cut)

    def looked_up(self, parts: list[str]) -> list[tuple[float, float, bytes]]:
        """Score of the best, loss of the second and ids of the best, of different parts.

        What lies between two safe places comes back in many parts; it is searched once and
        remembered.
        """
        if self.cut_bytes > MEMO:
            self.old_cuts, self.cuts, self.cut_bytes = self.cuts, {}, 0
        if not parts:
            return []
        text, stops = "".join(parts), np.cumsum([len(x) for x in parts])
        places = self._cut_ends(text, stops)
        bounds = places.tolist()
        own = [text[x:y] for x, y in zip([0, *bounds], bounds)]
        found = list(map(self.cuts.get, own))
        new = list(dict.fromkeys([x for x, known in zip(own, found, strict=True) if known is None]))
        if new:
            old = self.old_cuts
            self.cuts.update((x, old[x]) for x in new if x in old)
            unknown = [x for x in new if x not in old]
            if unknown:
                self.cuts.update(self._learnt(unknown))
            self.cut_bytes += sum(ENTRY + 2 * len(x) + len(self.cuts[x][2]) for x in new)
            found = list(map(self.cuts.__getitem__, own))
        firsts = np.concatenate([[0], np.searchsorted(places, stops) + 1])
        scores, losses = (np.array([x[k] for x in found], np.float64) for k in (0, 1))
        scores = np.add.reduceat(scores, firsts[:-1]).tolist()
        losses = np.minimum.reduceat(losses, firsts[:-1]).tolist()
        data, at = [x[2] for x in found], firsts.tolist()
        ids = [data[x] if y == x + 1 else b"".join(data[x:y]) for x, y in zip(at, at[1:])]
        return list(zip(scores, losses, ids, strict=True))

    # -- texts

    def parts(self, text: str) -> list[str]:
        """The text with marks for spaces, cut before each run of marks."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return _PARTS.findall(marked) if self.parted else [marked]

    def _others(self, part: str, n: int) -> list[Segmentation]:
        """``n_best`` of a part; texts often share the ones that lose least, so some short ones
        are remembered."""
        if len(part) > SHORT:
            return self.n_best(part, n)
        found = self.near.get((part, n))
        if found is None:
            if len(self.near) >= NEAR:
                self.near.clear()
            found = self.near[part, n] = self.n_best(part, n)
        return found

    def _joined_ways(
        self, part: Callable[[int], str], best: float, losses: list[float] | np.ndarray, n: int
    ) -> list[tuple[float, dict[int, bytes]]]:
        """Up to n ways through the parts: (score, {part: other ids})."""
        near = nearest_parts(losses, n)
        others = [self._others(part(k), n) for k in near]
        out = []
        for loss, way in join_parts([[s for s, _ in found] for found in others], n):
            changed = {near[a]: np.array(others[a][c][1], "<u4").tobytes() for a, c in way}
            out.append((best - loss, changed))
        return out

    def ways(self, text: str, n: int) -> tuple[list[bytes], list[tuple[float, dict[int, bytes]]]]:
        """The best ids of each part, and up to n ways: (score, {part: other ids})."""
        parts = self.parts(text)
        different = list(dict.fromkeys(parts))
        known = dict(zip(different, self.looked_up(different), strict=True))
        own = [known[p] for p in parts]
        best, losses = sum([x[0] for x in own]), [x[1] for x in own]
        found = self._joined_ways(parts.__getitem__, best, losses, n)
        return [x[2] for x in own], found

    def ways_of_many(self, texts: list[str], n: int) -> Iterator[tuple]:
        """For each text its ids, the ways, and for every part changed by one the ids of its
        best. The parts of all texts are numbered at once, each different one is looked up once,
        and ids are gathered by numbers. Texts that do not hold single spaces alone are parted
        one by one."""
        odd = [not t or t[0] == " " or t[-1] == " " or "  " in t or MARK in t for t in texts]
        plain = [t for t, o in zip(texts, odd, strict=True) if not o]
        rest = [t for t, o in zip(texts, odd, strict=True) if o]
        groups = [self._ways_of(x, n, k) for k, x in enumerate((plain, rest))]
        for o in odd:
            yield next(groups[o])

    def _ways_of(self, texts: list[str], n: int, odd: int) -> Iterator[tuple]:
        if odd or not self.parted:
            split = [self.parts(t) for t in texts]
            places = np.cumsum([0, *map(len, split)])
            column = pa.array([p for x in split for p in x], pa.large_string())
        else:
            # Single spaces between characters: what lies between them is a part but for its mark.
            found = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
            column, places = found.flatten(), found.offsets.to_numpy()
        coded = column.dictionary_encode()
        parts = coded.dictionary.to_pylist()
        if self.parted and not odd:
            parts = [MARK + p for p in parts]
        known = self.looked_up(parts)
        best, losses = (np.array([x[k] for x in known], np.float64) for k in (0, 1))
        data = [x[2] for x in known]
        del known
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(data), "<u4")
        del coded, column
        for x, y in zip(places[:-1].tolist(), places[1:].tolist()):
            at = codes[x:y]
            lost, own = losses[at], sizes[at]
            ends = np.cumsum(own)
            whole = ids[np.repeat(starts[at] - ends + own, own) + np.arange(own.sum())]
            part = lambda j: parts[at[j]]  # noqa: B023, E731
            found = self._joined_ways(part, sum(best[at].tolist()), lost, n)
            first = {j: data[at[j]] for _, changed in found for j in changed}
            yield whole, found, first

    def encode(self, text: str, n: int = N_BEST) -> list[Segmentation]:
        """Up to n segmentations of a text, best first."""
        own, found = self.ways(text, n)
        out = []
        for score, changed in found:
            parts = own if not changed else [changed.get(k, x) for k, x in enumerate(own)]
            out.append((score, tuple(np.frombuffer(b"".join(parts), "<u4").tolist())))
        return out

    def decode(self, ids: tuple[int, ...] | list[int]) -> str:
        """The text of ids; the prefix space goes."""
        return self._joined(ids)[1:]

    def reads(self, ids: np.ndarray, text: str) -> bool:
        """Whether ids decode to the text."""
        shown = self.shown_bytes.take(pa.array(ids)).buffers()[2]
        same = (shown.to_pybytes() if shown else b"")[1:] == text.encode("utf-8", "surrogatepass")
        return same or self.decode(ids.tolist()) == text

    def _joined(self, ids: tuple[int, ...] | list[int]) -> str:
        text = "".join(map(self.shown.__getitem__, ids))
        return text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def nearest_parts(losses: list[float] | np.ndarray, n: int) -> list[int]:
    """The n - 1 parts that lose least by their second way, the later first among equals."""
    if n <= 1 or not len(losses):
        return []
    loss = np.asarray(losses)
    near = np.arange(len(loss))
    if len(loss) >= n:
        near = np.flatnonzero(loss <= np.partition(loss, n - 2)[n - 2])
    near = near[np.lexsort((-near, loss[near]))][: n - 1]
    return [int(k) for k in near if np.isfinite(loss[k])]


def join_parts(scores: list[list[float]], n: int) -> list[tuple[float, tuple]]:
    """The n best ways to take one alternative of each part: (loss, ((part, alternative), ...)).

    ``scores`` are the alternatives' scores of the parts in order of their second's loss. The
    search goes over the chain of parts; the loss still to come is exactly none, as every part
    left alone keeps its best. A way is extended by changing its last part once more, or by
    changing a part further down the list.
    """
    heap: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
    out: list[tuple[float, tuple]] = []
    while heap and len(out) < n:
        loss, way = heapq.heappop(heap)
        out.append((loss, way))
        last, taken = way[-1] if way else (-1, 0)
        if way and taken + 1 < len(scores[last]):
            more = loss + scores[last][taken] - scores[last][taken + 1]
            heapq.heappush(heap, (more, (*way[:-1], (last, taken + 1))))
        for a in range(last + 1, len(scores)):
            heapq.heappush(heap, (loss + scores[a][0] - scores[a][1], (*way, (a, 1))))
    return out


def together(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about ``TOGETHER`` characters."""
    group: list[str] = []
    size = 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encoded(text: str | Column, path: str, n: int = N_BEST) -> Column:
    """Array of (score, ids): the n best segmentations of a text column, best first."""
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    @arrow_udf("array<struct<score:double,ids:array<int>>>")
    def encode(column: pa.Array) -> pa.Array:
        p = pieces(path)
        return pa.array(
            [[{"score": s, "ids": i} for s, i in p.encode(t, n)] for t in column.to_pylist()], kind
        )

    return encode(text_or_empty(text))


def decoded(ids: Column, path: str) -> Column:
    """The text of a column of ids; null ids give null."""

    @arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        p = pieces(path)
        return pa.array([None if i is None else p.decode(i) for i in column.to_pylist()], pa.string())

    return decode(ids)


def segmentation_digest(text: str | Column, path: str, n: int = N_BEST) -> Column:
    """Struct on the n best segmentations: how many there are, tokens, score and crc32 (little-endian
    uint32 ids) of the best, score of the second, bytes written for unknown characters, and
    whether every one of them decodes to the text."""

    @arrow_udf(ENCODED)
    def digest(column: pa.Array) -> pa.Array:
        p = pieces(path)
        rows = []
        for texts in together(column.to_pylist()):
            for t, (ids, found, own) in zip(texts, p.ways_of_many(texts, n), strict=True):
                # The other ways differ in the parts they change, and must read the same there.
                same = all(
                    p._joined(np.frombuffer(x, "<u4").tolist())
                    == p._joined(np.frombuffer(own[k], "<u4").tolist())
                    for _, changed in found
                    for k, x in changed.items()
                )
                rows.append(
                    (
                        len(found),
                        len(ids),
                        found[0][0],
                        zlib.crc32(ids),
                        found[1][0] if len(found) > 1 else None,
                        int(p.is_byte[ids].sum()),
                        same and p.reads(ids, t.replace(MARK, " ")),
                    )
                )
        return struct_column(rows, ENCODED_ARROW)

    return digest(text_or_empty(text))


def segmentations(
    docs: DataFrame, path: str, n: int = N_BEST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id and the digest of its n best segmentations."""
    s = docs.select(F.col(id_col), segmentation_digest(text_col, path, n).alias("s"))
    return s.select(id_col, "s.*")
