"""SentencePiece encoding and decoding with exact N-best segmentation.

The piece lattice of a text has an edge for each vocabulary piece, and for a
character that no piece covers an edge of its bytes. A forward Viterbi pass
gives every position the best score from the start; those scores are exact
heuristics, so an A-star search backward from the end pops whole segmentations
in order of their scores. Every path passes the points that no piece crosses
(see ``pieces.splitter``), so the lattice is a chain of small lattices, one per
pre-token. The forward pass runs once per distinct pre-token in a bounded memo.
In the N best of a text only the ``n - 1`` pre-tokens whose second best loses
least can leave their best path; they are searched, and the N best of the
whole text come from the same search over the chain of their N best.

Scores are sums of the model's piece scores. Among equal scores the order is
fixed by the search: longer last pieces first.

Defined cases: a null text has null results; an empty text has no pieces and
one segmentation of score 0; repeated rows are encoded each; a text of any
length is encoded whole; an empty table gives an empty result; extra columns
are ignored, whatever their names. Decoding gives the text back; the space mark itself,
where a text holds it, comes back as a space, as the library has it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import pieces

MEMO = 400_000
#: Pre-tokens whose N best are kept.
SEARCHED = 20_000
#: Score of one byte where no piece covers a character: below every piece of the model.
BYTE_SCORE = -100_000.0


class Lattice(dict):
    """N-best search for one model; the mapping is the memo of pre-tokens: (ids, score, loss of the second best)."""

    def __init__(self, path: str, n: int = 4):
        super().__init__()
        self.path, self.n = path, n
        self.vocabulary = pieces.vocabulary(path)
        self.automaton = pieces.automaton(path)
        self.single = frozenset(s for s in self.vocabulary if len(s) == 1)
        self.byte_ids = pieces.byte_ids(path)
        self.kind = np.uint16 if len(self.vocabulary) + 300 < 1 << 16 else np.uint32
        self.searched: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def edges(self, s: str) -> Iterable[tuple[int, tuple]]:
        """(last character, (length, id or ids of bytes, score)) of every edge, by where it ends and the longer first."""
        found = self.automaton.iter(s)
        if self.single.issuperset(s):
            return found
        bare = [(at, c.encode("utf-8", "surrogatepass")) for at, c in enumerate(s) if c not in self.single]
        return sorted([*found, *((at, (1, tuple(self.byte_ids[b] for b in raw), BYTE_SCORE * len(raw))) for at, raw in bare)], key=_place)

    def __missing__(self, s: str) -> tuple:
        """Forward pass with the two best scores of each position: the best path, and what the second best loses."""
        least = -math.inf
        first, second, back = [0.0], [least], [None]
        x = y = least
        at, path = 0, None
        for end, (size, own, w) in self.edges(s):
            if end != at:
                first.append(x)
                second.append(y)
                back.append(path)
                x = y = least
                at = end
            start = end + 1 - size
            t = first[start] + w
            if t > x:
                u = second[start] + w
                y = x if x > u else u
                x, path = t, (start, own)
            elif t > y:
                y = t
        back.append(path)
        ids, at = [], len(s)
        while at:
            at, own = back[at]
            ids.extend(own[::-1]) if type(own) is tuple else ids.append(own)
        if len(self) >= MEMO:
            self.clear()
        found = self[s] = (np.array(ids[::-1], self.kind).tobytes(), x, x - y)
        return found

    def search(self, s: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best (score, ids) of a pre-token, best first."""
        if s in self.searched:
            return self.searched[s]
        best = [0.0]  # Viterbi score from the start to each position
        into: list[list] = [[]]  # (minus score, start, ids) of the edges that end there; the first is the best
        for end, (size, own, w) in self.edges(s):
            if end == len(into) - 1:
                if end:
                    into[-1].sort(key=_order)
                    best.append(-into[-1][0][0])
                into.append([])
            start = end + 1 - size
            into[-1].append((-(best[start] + w), start, own))
        into[-1].sort(key=_order)
        best.append(-into[-1][0][0])
        out: list[tuple[float, tuple[int, ...]]] = []
        heap: list[tuple] = [(0.0, 0, len(s), 0, ())]  # (loss, serial, position, rank of the edge to take there, what follows)
        serial = 0
        while heap and len(out) < self.n:
            lost, _, at, k, tail = heapq.heappop(heap)
            base = lost - (into[at][k][0] - into[at][0][0]) if at else lost
            total = lost
            while at:  # after the edge of rank k the best edges follow: they lose nothing
                edges = into[at]
                if k + 1 < len(edges):
                    serial += 1
                    heapq.heappush(heap, (base + edges[k + 1][0] - edges[0][0], serial, at, k + 1, tail))
                _, at, own = edges[k]
                tail = (own, tail)
                base, k = total, 0
            ids: list[int] = []
            while tail:
                own, tail = tail
                ids.extend(own) if type(own) is tuple else ids.append(own)
            out.append((best[-1] - total, tuple(ids)))
        if len(self.searched) >= SEARCHED:
            self.searched.clear()
        self.searched[s] = out
        return out

    def text(self, text: str) -> tuple[np.ndarray, list[tuple[float, int]], list[list[Change]]]:
        """Best ids; (score, tokens) of each of the N best; and what each of them has in place of which best ids."""
        parts = pieces.splitter(self.path).findall(pieces.normalize(self.path, text))
        found = list(map(self.__getitem__, parts))
        ids = np.frombuffer(b"".join([f[0] for f in found]), self.kind).astype(np.int32)
        ranked, changes = self.chain(parts, found, sum([f[1] for f in found]), len(ids))
        size, where = np.dtype(self.kind).itemsize, {}
        ends = list(accumulate([len(f[0]) // size for f in found], initial=0)) if any(changes) else []
        for made in changes:
            where |= {i: (ends[i], ends[i + 1]) for i, _ in made}
        return ids, ranked, [[(*where[i], own) for i, own in sorted(made)] for made in changes]

    def chain(self, parts: list[str], found: list, score: float, tokens: int) -> tuple[list[tuple[float, int]], list[list[tuple[int, tuple[int, ...]]]]]:
        """N best of a chain of pre-tokens as differences from the best path: A-star over the pre-tokens that can matter."""
        losses = np.array([f[2] for f in found])
        few = min(self.n - 1, len(losses))
        near = np.flatnonzero(losses <= np.partition(losses, few - 1)[few - 1]) if few else losses
        matter = [i for i in near[np.argsort(losses[near], kind="stable")[:few]].tolist() if losses[i] < math.inf] if few else []
        best = [self.search(parts[i]) for i in matter]
        heap: list[tuple] = [(0.0, 0, (), 0)]  # (loss, more tokens, changes, pre-tokens decided)
        ranked, changes = [], []
        while heap and len(ranked) < self.n:
            lost, more, made, at = heapq.heappop(heap)
            if at == len(matter):
                ranked.append((score - lost, tokens + more))
                changes.append(list(made))
                continue
            f = best[at]
            for k, (w, own) in enumerate(f):  # what is undecided can lose nothing: the heuristic is exact
                heapq.heappush(heap, (lost + f[0][0] - w, more + len(own) - len(f[0][1]), made + ((matter[at], own),) if k else made, at + 1))
        return ranked, changes


#: The best ids [start, stop) that one pre-token has, and the ids in their place.
Change = tuple[int, int, tuple[int, ...]]


def changed(ids: np.ndarray, changes: list[Change]) -> np.ndarray:
    """The ids of one of the N best segmentations, from the best and its changes in order."""
    parts, at = [], 0
    for start, stop, own in changes:
        parts += [ids[at:start], np.array(own, np.int32)]
        at = stop
    return np.concatenate([*parts, ids[at:]]) if parts else ids


def digest(ids: np.ndarray) -> int:
    """A signed 64-bit hash of an id sequence."""
    return int(np.array(xxhash.xxh3_64_intdigest(np.ascontiguousarray(ids, "<i4").tobytes()), np.uint64).view(np.int64))


def _order(edge: tuple) -> tuple:
    return edge[:2]


def _place(edge: tuple) -> tuple:
    return edge[0], -edge[1][0]


class Decoder:
    def __init__(self, path: str):
        sp = pieces.processor(path)
        raw = [sp.id_to_piece(i).replace(pieces.SPACE, " ").encode() for i in range(sp.vocab_size())]
        for b, i in enumerate(pieces.byte_ids(path)):
            raw[i] = bytes([b])
        self.raw = raw

    def text(self, ids: list[int] | np.ndarray) -> str:
        """The text of an id sequence; the space that encoding puts in front goes."""
        joined = b"".join(map(self.raw.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def shared(path: str, n: int) -> tuple[Lattice, Decoder]:
    """Kept for the life of a worker process, so that its tasks share one memo."""
    return Lattice(path, n), Decoder(path)


def encode(docs: DataFrame, path: str | None = None, n: int = 4, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, library: bool = False) -> DataFrame:
    """``doc_id, ids, changes, n_tokens, scores, sizes, digests, round_trip``: the best segmentation, what each of the N best changes in it, their scores, tokens and digests, and whether decoding gives the text back.

    :func:`changed` gives the ids of any of the N. Without ``keep_ids`` ids and changes are left out. With ``library``, ``library_ids``
    holds the ids of the model's own encoder, which merges pairs where this search sums scores.
    """
    path = path or pieces.model_path()
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", *["ids", "changes"] * keep_ids, "n_tokens", "scores", "sizes", "digests", "round_trip", *["library_ids"] * library]
    types = {"doc_id": kind, "ids": "array<int>", "library_ids": "array<int>", "n_tokens": "long", "scores": "array<double>", "sizes": "array<long>", "digests": "array<long>", "changes": "array<array<struct<start: int, stop: int, ids: array<int>>>>", "round_trip": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, decoder = shared(path, n)
        for b in batches:
            rows: dict[str, list] = {k: [] for k in names[1:]}
            for t in b.column(1):
                t = t.as_py()
                if t is None:
                    row = dict.fromkeys(names[1:])
                else:
                    ids, ranked, changes = lattice.text(t)
                    row = {"ids": ids, "n_tokens": len(ids), "scores": [s for s, _ in ranked], "sizes": [m for _, m in ranked], "digests": [digest(changed(ids, c)) for c in changes], "round_trip": decoder.text(ids) == t.replace(pieces.SPACE, " ")}
                    if library:
                        row["library_ids"] = pieces.processor(path).encode(t)
                    if keep_ids:
                        row["changes"] = [[{"start": a, "stop": z, "ids": own} for a, z, own in c] for c in changes]
                for k in rows:
                    rows[k].append(row[k])
            arrow = {"ids": pa.list_(pa.int32()), "library_ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "scores": pa.list_(pa.float64()), "sizes": pa.list_(pa.int64()), "digests": pa.list_(pa.int64()), "changes": pa.list_(pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))]))), "round_trip": pa.bool_()}
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(rows[k], arrow[k]) for k in rows)], names=names)

    schema = ", ".join(f"{k} {types[k]}" for k in names)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of every row of ids; null ids give a null text."""
    path = path or pieces.model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for b in batches:
            texts = [None if x.as_py() is None else decoder.text(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")
