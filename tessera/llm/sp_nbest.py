"""SentencePiece encoding and decoding with the N best segmentations.

A text is a lattice of the vocabulary's pieces. Forward Viterbi gives each node the best score from the start; these
are exact heuristics for an A-star search backwards from the end, which completes the N best paths in order. Pieces
never reach over the start of a blank run or a line end, so the lattice of a text falls into those of its chunks; the
N best paths of the whole differ from the best one only in the N - 1 chunks whose second-best path loses least, so the
search runs over these and the other chunks stay at their best.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import in_slices, read, text_of

Edge = tuple[int, tuple[int, ...], float]  # start, piece ids, score


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary from a SentencePiece model's bytes.

    The file's scores are used as they are, unless they are merge ranks (0, -1, -2, ...), which are no log
    probabilities: rank r then counts as a Zipf probability, log(1 / (r + 2)) less its normaliser. Characters without a
    piece fall back to their UTF-8 bytes, each a little less probable than the rarest piece. A blank stands for the
    model's blank mark, so a text's own blank marks fall back to bytes, too, and every text decodes to itself.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names, scores = {}, {}
        self.byte_ids = [-1] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[b] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                names[i] = sp.id_to_piece(i).replace("▁", " ")
                scores[i] = sp.get_score(i)
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        if all(s <= 0 and s == int(s) for s in scores.values()):
            norm = math.log(sum(1 / (2 - s) for s in scores.values()))
            scores = {i: -math.log(2 - s) - norm for i, s in scores.items()}
        self.pieces = {names[i]: (i, s) for i, s in scores.items()}
        self.raw = {i: bytes([b]) for b, i in enumerate(self.byte_ids)} | {i: name.encode() for i, name in names.items()}
        self.byte_score = min(scores.values()) - math.log(2)
        #: a trie: [children by character, id or -1 where no piece ends, score]
        self.trie: dict[str, list] = {}
        for p, (i, score) in self.pieces.items():
            children = self.trie
            for c in p:
                node = children.setdefault(c, [{}, -1, 0.0])
                children = node[0]
            node[1:] = [i, score]
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces):
            raise ValueError("pieces reach over blanks or line ends, so chunks can't be segmented by themselves")
        self._tabulate()

    def _tabulate(self) -> None:
        """The trie as arrays, to walk many chunks in step. Nodes are numbered, inner ones first (0: none, 1: the root);
        characters that follow others in a piece have a class, all others class 0, which leads nowhere."""
        paths = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        inner = {p[:k] for p in self.pieces for k in range(1, len(p))}
        number = {p: k for k, p in enumerate(chain(sorted(inner), sorted(paths - inner)), 2)}
        self.inner = len(inner) + 1
        follow = sorted({c for p in paths for c in p[1:]})
        self.n_classes = len(follow) + 1
        self.root = np.zeros(_PAD + 1, np.int32)
        self.classes = np.zeros(_PAD + 1, np.int32)
        self.classes[[ord(c) for c in follow]] = np.arange(1, self.n_classes)
        self.child = np.zeros((self.inner + 1) * self.n_classes, np.int32)
        self.piece_at, self.score_at = np.full(len(number) + 2, -1, np.int32), np.zeros(len(number) + 2)
        for p, node in number.items():
            if len(p) == 1:
                self.root[ord(p)] = node
            else:
                self.child[number[p[:-1]] * self.n_classes + self.classes[ord(p[-1])]] = node
            if p in self.pieces:
                self.piece_at[node], self.score_at[node] = self.pieces[p]
        #: characters that are pieces themselves, so that no path needs bytes for them
        self.plain = self.piece_at[self.root] >= 0

    def edges_at(self, s: str, start: int) -> list[tuple[int, tuple[int, ...], float]]:
        """(end, ids, score) of the edges that leave a node."""
        children, out = self.trie, []
        for end in range(start, len(s)):
            node = children.get(s[end])
            if node is None:
                break
            children = node[0]
            if node[1] >= 0:
                out.append((end + 1, (node[1],), node[2]))
        if not out or out[0][0] > start + 1:
            out.append((start + 1, *self.as_bytes(s[start])))
        return out

    def as_bytes(self, c: str) -> tuple[tuple[int, ...], float]:
        raw = c.encode("utf-8", "replace")
        return tuple(self.byte_ids[b] for b in raw), self.byte_score * len(raw)

    def best_two(self, s: str) -> tuple[float, tuple[int, ...], float]:
        """Best score, its ids, and what the second-best path of a chunk loses (infinite where there is one path)."""
        n, low, trie = len(s), -math.inf, self.trie
        first, second, back, step = [0.0] + [low] * n, [low] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        for i in range(n):
            one, two, children, bare = first[i], second[i], trie, True
            end = i
            while end < n:
                node = children.get(s[end])
                if node is None:
                    break
                children, piece, score = node
                end += 1
                if piece < 0:
                    continue
                if end == i + 1:
                    bare = False
                a = one + score
                if a > first[end]:
                    second[end] = first[end] if first[end] > two + score else two + score
                    first[end], back[end], step[end] = a, i, piece
                elif a > second[end]:
                    second[end] = a
            if bare:
                ids, score = self.as_bytes(s[i])
                end, a = i + 1, one + score
                if a > first[end]:
                    second[end] = max(first[end], two + score)
                    first[end], back[end], step[end] = a, i, ids
                else:
                    second[end] = max(second[end], a)
        ids, at = [], n
        while at:
            x = step[at]
            if type(x) is int:
                ids.append(x)
            else:
                ids.extend(reversed(x))
            at = back[at]
        ids.reverse()
        return first[n], tuple(ids), first[n] - second[n]

    def best_of(self, chunks: list[str]) -> _Best:
        """``best_two`` of many chunks: in step, shortest first, but for long chunks and those that need bytes."""
        lens = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lens) - lens
        alone = (lens > LONG) | (np.add.reduceat(~self.plain[codes], starts, dtype=np.int64) > 0)
        out = _Best(np.empty(len(chunks)), np.empty(len(chunks)), np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64), [])
        filled = 0
        easy = np.flatnonzero(~alone)
        easy = easy[np.argsort(lens[easy], kind="stable")]
        for lo in range(0, len(easy), IN_STEP):
            rows = easy[lo : lo + IN_STEP]
            size = lens[rows]
            place = np.arange(size[-1])[:, None]
            block = np.where(place < size, codes[np.minimum(starts[rows] + place, len(codes) - 1)], _PAD)
            out.score[rows], out.loss[rows], out.count[rows], ids = self._in_step(block, size)
            out.start[rows] = filled + np.cumsum(out.count[rows]) - out.count[rows]
            out.ids.append(ids)
            filled += len(ids)
        for k in np.flatnonzero(alone).tolist():
            out.score[k], ids, out.loss[k] = self.best_two(chunks[k])
            out.start[k], out.count[k] = filled, len(ids)
            out.ids.append(np.array(ids, np.int32))
            filled += len(ids)
        out.ids = [np.concatenate(out.ids)]
        return out

    def _in_step(self, block: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi over columns of code points, shortest first: scores, losses, numbers of ids, and the ids."""
        width, m = block.shape
        first, second = np.full((width + 1, m), -np.inf), np.full((width + 1, m), -np.inf)
        first[0] = 0
        back, step = np.zeros((width + 1, m), np.int8), np.zeros((width + 1, m), np.int32)
        classes = self.classes[block]
        for i in range(width):
            on = np.arange(np.searchsorted(size, i, side="right"), m)
            node = self.root[block[i, on]]
            for end in range(i + 1, width + 1):
                piece = self.piece_at[node]
                has = piece >= 0
                cols, score = on[has], self.score_at[node[has]]
                a, before = first[i, cols] + score, first[end, cols]
                better = a > before
                second[end, cols] = np.where(better, np.maximum(before, second[i, cols] + score), np.maximum(second[end, cols], a))
                cols = cols[better]
                first[end, cols], back[end, cols], step[end, cols] = a[better], i, piece[has][better]
                if end == width:
                    break
                more = node <= self.inner
                on, node = on[more], node[more]
                node = self.child[node * self.n_classes + classes[end, on]]
                on, node = on[node > 0], node[node > 0]
                if not len(on):
                    break
        every = np.arange(m)
        best, loss = first[size, every], first[size, every] - second[size, every]
        count, from_end = np.zeros(m, np.int64), np.zeros((width, m), np.int32)
        cols, at = every, size
        while len(cols):
            from_end[count[cols], cols] = step[at, cols]
            count[cols] += 1
            at = back[at, cols].astype(np.int64)
            cols, at = cols[at > 0], at[at > 0]
        owner = np.repeat(every, count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return best, loss, count, from_end[count[owner] - 1 - place, owner]

    # ------------------------------------------------------------ documents

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(" " + text) if text else []

    def n_best(self, parts: list[str], n: int) -> list[tuple[float, list[tuple[int, ...]]]]:
        """The n best joint segmentations of chunks, best first: score, and ids per chunk. Forward Viterbi, then A-star
        from the end with the forward scores as heuristics."""
        incoming: list[list[Edge]] = [[]]
        owner = [0]
        for k, s in enumerate(parts):
            base = len(incoming) - 1
            incoming += [[] for _ in s]
            owner += [k] * len(s)
            for i in range(len(s)):
                for end, ids, score in self.edges_at(s, i):
                    incoming[base + end].append((base + i, ids, score))
        ahead = [0.0] + [-math.inf] * (len(incoming) - 1)
        for node in range(1, len(incoming)):
            ahead[node] = max(ahead[start] + score for start, _, score in incoming[node])
        # ordered by what a path loses on the best one: exactly 0 along the best, whatever sums of scores round to
        out, tie = [], 0
        heap = [(0.0, 0, len(incoming) - 1, 0.0, None)]
        while heap and len(out) < n:
            loss, _, node, done, path = heapq.heappop(heap)
            if node == 0:
                ids: list[list[int]] = [[] for _ in parts]
                while path:
                    k, step, path = path
                    ids[k].extend(step)
                out.append((done, [tuple(x) for x in ids]))
                continue
            for start, ids, score in incoming[node]:
                tie -= 1  # of equal scores the newest first, so that a run of ties is followed to its end
                lost = loss + (ahead[node] - (ahead[start] + score))
                heapq.heappush(heap, (lost, tie, start, done + score, (owner[node], ids, path)))
        return out

    def encode_all(self, texts: list[str], n: int = 1) -> list[list[tuple[float, np.ndarray]]]:
        """Per text its n best segmentations, best first: score and ids (fewer where there are fewer). Equal chunks of
        the texts are segmented once."""
        parts = [self.chunks(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts]).tolist()
        if not ends or not ends[-1]:
            return [[(0.0, np.empty(0, np.int32))] for _ in texts]
        codes, distinct = pd.factorize(np.array(list(chain.from_iterable(parts)), object))
        best = self.best_of(list(distinct))
        scores, losses, counts = best.score[codes], best.loss[codes], best.count[codes]
        stops = np.cumsum(counts)
        ids = best.ids[0][np.repeat(best.start[codes] - stops + counts, counts) + np.arange(stops[-1])]
        out, lo = [], 0
        for own, hi in zip(parts, ends, strict=True):
            if hi == lo:
                out.append([(0.0, np.empty(0, np.int32))])
                continue
            begin = int(stops[lo] - counts[lo])
            found = [(float(scores[lo:hi].sum()), ids[begin : stops[hi - 1]])]
            free = _smallest(losses[lo:hi], n - 1)
            if free:
                rest = found[0][0] - math.fsum(scores[lo + k] for k in free)
                for rank, (score, new) in enumerate(self.n_best([own[k] for k in free], n)):
                    if rank:
                        whole, done = [], begin
                        for k, x in zip(free, new, strict=True):
                            whole += [ids[done : stops[lo + k] - counts[lo + k]], x]
                            done = stops[lo + k]
                        found.append((rest + score, np.concatenate([*whole, ids[done : stops[hi - 1]]]).astype(np.int32)))
            out.append(found)
            lo = hi
        return out

    def encode(self, text: str, n: int = 1) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text, best first: score and ids (fewer where there are fewer)."""
        return [(score, ids.tolist()) for score, ids in self.encode_all([text], n)[0]]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


@dataclass
class _Best:
    """Per chunk the best score, what the second-best path loses (infinite where there is one path), and where its ids are."""

    score: np.ndarray
    loss: np.ndarray
    start: np.ndarray
    count: np.ndarray
    ids: list[np.ndarray]


def _smallest(losses: np.ndarray, n: int) -> list[int]:
    """Places of the n smallest finite values, of equal ones the first, in order of place."""
    if n <= 0:
        return []
    edge = np.partition(losses, n - 1)[n - 1] if n < len(losses) else np.inf
    under = np.flatnonzero(losses < edge)
    even = np.flatnonzero(losses == edge)[: n - len(under)] if edge < np.inf else under[:0]
    return sorted(np.concatenate([under, even]).tolist())


LONG = 32  # code points of the chunks that are segmented in step
IN_STEP = 16384  # of them at a time
BLOCK = 1_000_000  # code points of the texts that are segmented together
_PAD = 0x110000  # stands for no character
_CHUNK = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_LOADED: dict[bytes, Pieces] = {}  # per Python worker


def loaded(model: bytes) -> Pieces:
    key = hashlib.sha1(model).digest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def _blocks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in runs of about BLOCK code points, so that memory does not grow with the batch."""
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


SCHEMA = "ids array<array<int>>, scores array<double>, decoded string"


def segmentations(docs: DataFrame, n: int = 4, model: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc`` (the row as a struct) and ``best``: ids and scores of the n best segmentations of the whole text
    (fewer where there are fewer), best first, and the text that the best one's ids decode to.

    Null text is read as empty; an empty text has no pieces and one segmentation of score 0. Equal scores come in the
    search's order, which is fixed. Texts of any length are segmented whole; long runs of one letter, where very many
    segmentations tie, take time in proportion to their length. Empty input: empty result. ``model`` is a
    SentencePiece model file that the driver reads; tasks get its bytes.
    """
    with open(model or default_model(), "rb") as f:
        proto = f.read()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(proto)
        for batch in batches:
            doc, at = batch.column("doc"), 0
            for block in _blocks(t or "" for texts in in_slices(doc.field("text")) for t in texts):
                found = pieces.encode_all(block, n)
                best = pa.StructArray.from_arrays([
                    pa.array([[ids for _, ids in f] for f in found], pa.list_(pa.list_(pa.int32()))),
                    pa.array([[score for score, _ in f] for f in found], pa.list_(pa.float64())),
                    pa.array([pieces.decode(f[0][1].tolist()) for f in found], pa.string())], ["ids", "scores", "decoded"])
                yield pa.RecordBatch.from_arrays([doc.slice(at, len(block)), best], names=["doc", "best"])
                at += len(block)

    kind = T.StructType([T.StructField("doc", docs.schema), T.StructField("best", T.StructType.fromDDL(SCHEMA))])
    return docs.select(F.struct("*").alias("doc")).mapInArrow(encode, kind)


def op5_nbest_pieces(spark, sf_dir):
    """Digests of the four best segmentations of every document and of the decoded text."""
    out = segmentations(read(spark, sf_dir, "documents").select("doc_id", "text"))
    out = out.withColumn("digests", F.transform("best.ids", lambda x: F.sha2(F.array_join(x, ","), 256)))
    best = F.get("best.ids", F.lit(0))
    return out.select("doc.doc_id", F.size(best).cast("long").alias("n_pieces"), F.get("digests", F.lit(0)).alias("ids_sha256"),
                      F.transform("best.scores", lambda x: F.round(x, 6)).alias("scores"), F.get("digests", F.lit(1)).alias("second_sha256"),
                      F.col("digests").alias("all_sha256"),
                      F.sha2("best.decoded", 256).alias("decoded_sha256"), (F.col("best.decoded") == text_of(F.col("doc.text"))).alias("round_trip"))
