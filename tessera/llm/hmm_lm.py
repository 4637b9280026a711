"""LM scoring with a hidden Markov language model.

Training documents are counted (words and an end, A-Z lower-cased). The most frequent words, at most VOCABULARY, are
symbols of their own; every other word is the symbol of its length class, and then itself by its smoothed share in the
class. The counts of at most KNOWN words go to the tasks; those of the others are joined. Baum-Welch trains STATES latent states over the symbols: each partition runs forward
and backward recursions over its documents and yields expected counts, and Spark sums them, until the log likelihood
gains less than TOLERANCE a token. It starts from a model trained likewise on a bounded sample, in which the states
have parted; that takes most of the iterations. A document's log
probability is the exact scaled forward likelihood of its symbols plus the shares of its rare words, which come from a
join with the counts, as do the base score's. Nothing that grows with the corpus's vocabulary is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, cut_lineage, read, text_of

VOCABULARY = 16_000  # words that are symbols of the model, at most
KNOWN = 60_000  # words whose counts tasks get, at most; an id takes two bytes
CLASSES = 16  # by length; the last holds all longer words
STATES = 4
TOLERANCE = 0.002  # training ends when an iteration gains less log likelihood (natural) a token; a tenth of it in the sample
START_TOKENS = 150_000  # of the sample that the training starts with
SMOOTH = 0.1
BLOCK = 512  # tokens of a block; only documents of several blocks need transfer matrices
CHUNK = 400_000  # tokens about that a pass holds the distributions of
END = "\n"  # no word holds one


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 7. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, c, level) over all training documents; ends count as END."""
    words = F.filter(F.split(ascii_lower(text_of()), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tokens = docs.where(~held_out(F.col("doc_id"))).select(F.explode(F.concat(words, F.array(F.lit(END)))).alias("word"))
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    return cut_lineage(counts.withColumn("level", F.floor(F.log2("c") * 16).cast("int")))


def thresholds(counts: DataFrame, *most: int) -> list[int]:
    """For each bound the lowest level such that no more words are at it or above. A level is a sixteenth of an octave
    of the count, so the histogram has some hundred rows whatever the corpus."""
    found, above = [2**31 - 1] * len(most), 0
    for level, n in sorted(counts.groupBy("level").count().collect(), reverse=True):
        above += n
        found = [level if above <= m else f for m, f in zip(most, found, strict=True)]
    return found


class Symbols:
    """Ids of words: END first, then the known words by count; then the classes of the others. ``symbol`` gives an
    id's symbol in the model: the END, the first ``own`` words, then the classes."""

    def __init__(self, words: list[str], own: int):
        self.ids = {w.encode(): i for i, w in enumerate([END, *words])}
        self.first_class = len(self.ids)
        self.n = 1 + own + CLASSES
        classes = [own + min(len(w), CLASSES) for w in words[own:]]
        self.symbol = np.array([*range(own + 1), *classes, *range(own + 1, self.n)], np.int32)

    def encode(self, text: str) -> tuple[np.ndarray, list[str]]:
        """Ids of a text with its end, and the words that aren't known. Bytes are lowered and split at ASCII characters
        alone, which are the letters and spaces that tokens are defined by."""
        words = text.encode().lower().split()
        words.append(END.encode())
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))
        places = np.flatnonzero(ids < 0)
        rare = [words[i].decode() for i in places.tolist()]
        if rare:
            ids[places] = [self.first_class - 1 + min(len(w), CLASSES) for w in rare]
        return ids.astype(np.uint16), rare


# ---------------------------------------------------------------- recursions


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents cut into blocks of BLOCK tokens: for each block its document, and its number in the document."""
    n = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


class _Steps:
    """Blocks by falling size and their tokens step by step: step t holds token t of every block longer than t, which
    are the first blocks, at ``cuts[t]`` to ``cuts[t + 1]``."""

    def __init__(self, blocks: np.ndarray, at: np.ndarray, sizes: np.ndarray, symbols: np.ndarray):
        order = np.argsort(-sizes[blocks], kind="stable")
        self.blocks, self.sizes = blocks[order], sizes[blocks[order]]
        live = np.searchsorted(-self.sizes, -np.arange(self.sizes[0]), side="left")
        self.cuts = np.concatenate([[0], np.cumsum(live)])
        step = np.repeat(np.arange(len(live)), live)
        self.block = np.arange(len(step)) - self.cuts[step]  # a token's block, by its place in ``blocks``
        self.tokens = symbols[at[self.blocks][self.block] + step]

    def spans(self) -> list[tuple[int, int]]:
        cuts = self.cuts.tolist()
        return list(zip(cuts[:-1], cuts[1:], strict=True))


class Recursion:
    """Scaled forward and backward recursions over a batch of documents, many blocks in step.

    A document of one block starts from the model and ends free. For longer ones, a block's transfer matrix is the
    product of its tokens' transition and emission matrices, scaled as it grows; the state distributions before the
    blocks and the backward vectors after them follow from these. Then every block is by itself: a forward pass keeps
    each token's distribution and scale, and the backward pass divides by the same scales, so that the product of both
    is a token's state probability. Blocks pass in chunks of about CHUNK tokens, however long a document is.
    """

    def __init__(self, model: dict, symbols: np.ndarray, lengths: np.ndarray):
        self.k = len(model["start"])
        self.A, self.E = model["move"], np.ascontiguousarray(model["emit"].T)  # E: symbol x state
        self.start, self.symbols, self.lengths = model["start"], symbols, lengths
        self.owner, self.number = _layout(lengths)
        self.at = np.concatenate([[0], np.cumsum(lengths)[:-1]])[self.owner] + self.number * BLOCK
        self.sizes = np.minimum(BLOCK, lengths[self.owner] - self.number * BLOCK)

    def _chunks(self, blocks: np.ndarray) -> Iterator[_Steps]:
        blocks = blocks[np.argsort(-self.sizes[blocks], kind="stable")]
        chunk = np.cumsum(self.sizes[blocks]) // CHUNK
        for part in np.split(blocks, np.flatnonzero(np.diff(chunk)) + 1):
            if len(part):
                yield _Steps(part, self.at, self.sizes, self.symbols)

    def _transfers(self, blocks: np.ndarray) -> np.ndarray:
        """Of ``blocks``, the product over the tokens of (move, then emit), up to scale; other blocks' are left empty."""
        k = self.k
        out = np.empty((len(self.owner), k, k)) if len(blocks) else np.empty((0, k, k))
        for steps in self._chunks(blocks):
            T = np.broadcast_to(np.eye(k), (len(steps.blocks), k, k)).copy()
            for t, (a, b) in enumerate(steps.spans()):
                grown = (T[: b - a].reshape(-1, k) @ self.A).reshape(-1, k, k)
                np.multiply(grown, self.E[steps.tokens[a:b]][:, None, :], out=T[: b - a])
                if t % 16 == 15:
                    T[: b - a] /= T[: b - a].max(axis=(1, 2))[:, None, None]
            out[steps.blocks] = T / T.max(axis=(1, 2))[:, None, None]
        return out

    def boundaries(self) -> tuple[np.ndarray, np.ndarray]:
        """State distribution before each block, and the backward vector after it, up to scale."""
        before = np.broadcast_to(self.start, (len(self.owner), self.k)).copy()
        after = np.ones((len(self.owner), self.k))
        blocks = np.flatnonzero((self.lengths > BLOCK)[self.owner])
        T = self._transfers(blocks)
        order = blocks[np.argsort(self.number[blocks], kind="stable")]
        cuts = np.flatnonzero(np.diff(self.number[order], prepend=0)) if len(order) else []
        later = np.split(order, cuts)[1:]  # the second blocks of all documents, then the third
        for here in later:
            state = np.einsum("bi,bij->bj", before[here - 1], T[here - 1])
            before[here] = state / state.sum(1)[:, None]
        for here in reversed(later):
            state = np.einsum("bij,bj->bi", T[here], after[here])
            after[here - 1] = state / state.sum(1)[:, None]
        return before, after

    def _forward(self, steps: _Steps, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token its emissions, the state distribution after it, and its scale (its probability after those before)."""
        emit = self.E[steps.tokens]
        alpha, scale, ones = np.empty_like(emit), np.empty(len(emit)), np.ones(self.k)
        state = before
        for a, b in steps.spans():
            here = alpha[a:b]
            np.matmul(state[: b - a], self.A, out=here)
            here *= emit[a:b]
            np.matmul(here, ones, out=scale[a:b])
            here /= scale[a:b, None]
            state = here
        return emit, alpha, scale

    def _likely(self, steps: _Steps, scale: np.ndarray, total: np.ndarray) -> None:
        of_block = np.bincount(steps.block, np.log(scale), minlength=len(steps.blocks))
        np.add.at(total, self.owner[steps.blocks], of_block)

    def likelihoods(self) -> np.ndarray:
        before, _ = self.boundaries()
        total = np.zeros(len(self.lengths))
        for steps in self._chunks(np.arange(len(self.owner))):
            _, _, scale = self._forward(steps, before[steps.blocks])
            self._likely(steps, scale, total)
        return total

    def expected(self, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts: of first states (before the first move), moves and emissions; and the log likelihood."""
        before, after = self.boundaries()
        k = self.k
        first, move, emitted, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_symbols)), np.zeros(len(self.lengths))
        back = np.ascontiguousarray(self.A.T)
        for steps in self._chunks(np.arange(len(self.owner))):
            start = before[steps.blocks]
            emit, alpha, scale = self._forward(steps, start)
            self._likely(steps, scale, total)
            last = alpha[steps.cuts[steps.sizes - 1] + np.arange(len(steps.blocks))]
            beta = after[steps.blocks]
            beta /= (last * beta).sum(1)[:, None]
            spans = steps.spans()
            for t in range(len(spans) - 1, -1, -1):
                a, b = spans[t]
                carried = emit[a:b]
                carried *= beta[: b - a]
                carried /= scale[a:b, None]
                prior = alpha[spans[t - 1][0] :][: b - a] if t else start[: b - a]
                move += prior.T @ carried
                alpha[a:b] *= beta[: b - a]
                np.matmul(carried, back, out=beta[: b - a])
            for i in range(k):
                emitted[i] += np.bincount(steps.tokens, weights=alpha[:, i], minlength=n_symbols)
            opening = self.number[steps.blocks] == 0
            first += (start[opening] * beta[opening]).sum(0)
        return first, move * self.A, emitted, float(total.sum())


def new_model(unigram: np.ndarray, states: int = STATES, seed: int = 5) -> dict:
    """Unigram emissions and even moves, shaken apart by seeded factors. Weak ones (0.5 to 1.5) leave the states so alike
    that early iterations gain almost nothing and would look like the end."""
    rng = np.random.default_rng(seed)
    emit = unigram[None, :] * np.exp(rng.normal(size=(states, len(unigram))))
    move = rng.uniform(0.5, 1.5, (states, states))
    return {"start": np.full(states, 1 / states), "move": move / move.sum(1)[:, None], "emit": emit / emit.sum(1)[:, None]}


def reestimated(first: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> dict:
    """The next model from expected counts, smoothed: moves evenly, emissions towards the unigram shares."""
    move, emit = move + SMOOTH, emit + SMOOTH * len(unigram) * unigram[None, :]
    return {"start": (first + SMOOTH) / (first + SMOOTH).sum(), "move": move / move.sum(1)[:, None], "emit": emit / emit.sum(1)[:, None]}


def _groups(sizes: list[int], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``most`` tokens, so a batch's arrays stay small."""
    begin = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= most:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def _recursions(blobs: list[bytes], model: dict, symbol: np.ndarray) -> Iterator[tuple[Recursion, int, int]]:
    sizes = [len(b) // 2 for b in blobs]
    for a, b in _groups(sizes):
        yield Recursion(model, symbol[np.frombuffer(b"".join(blobs[a:b]), np.uint16)], np.array(sizes[a:b])), a, b


# ---------------------------------------------------------------- jobs


def encoded(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """A written table: row (a number), doc_id, held_out, n_tokens, ids (binary, two bytes a token), rare (words)."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [symbols.encode(t) for t in pdf.pop("text")]
            yield pdf.assign(n_tokens=[len(x) for x, _ in rows], ids=[x.tobytes() for x, _ in rows], rare=[" ".join(r) for _, r in rows])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return cut_lineage(rows.mapInPandas(encode, "row long, doc_id string, held_out boolean, n_tokens long, ids binary, rare string"))


def _counted(blobs: list[bytes], model: dict, symbol: np.ndarray, n: int) -> np.ndarray:
    """Expected counts, a row a state: first states, moves, emissions; and last the log likelihood, in the first row."""
    k = len(model["start"])
    out = np.zeros((k, 2 + k + n))
    for r, _, _ in _recursions(blobs, model, symbol):
        first, move, emit, likely = r.expected(n)
        out[:, 0] += first
        out[:, 1 : k + 1] += move
        out[:, k + 1 : -1] += emit
        out[0, -1] += likely
    return out


def _converged(count, model: dict, unigram: np.ndarray, tokens: int, tolerance: float) -> dict:
    """``model`` re-estimated from ``count(model)`` until an iteration gains less than ``tolerance`` a token."""
    last, k = -math.inf, len(model["start"])
    while True:
        full = count(model)
        model = reestimated(full[:, 0], full[:, 1 : k + 1], full[:, k + 1 : -1], unigram)
        likely = full[0, -1] / max(tokens, 1)
        if likely - last < tolerance:
            return model
        last = likely


def trained(table: DataFrame, symbol: np.ndarray, unigram: np.ndarray, tokens: int) -> dict:
    """Baum-Welch over all training documents (of so many tokens). A partition yields one row of counts a state, so what
    reaches the driver is states x symbols numbers, summed by Spark; and the sample of the start, equal texts once."""
    n, k = len(unigram), STATES
    train = table.where(~F.col("held_out")).select("ids")
    share = min(1.0, START_TOKENS / max(tokens, 1))
    chosen = train.where(F.pmod(F.xxhash64("ids"), F.lit(1_000_000)) < share * 1_000_000).distinct()
    sample = sorted(bytes(r["ids"]) for r in chosen.collect())
    model = _converged(lambda m: _counted(sample, m, symbol, n), new_model(unigram, k), unigram, sum(map(len, sample)) // 2, TOLERANCE / 10)

    def over_all(model: dict) -> np.ndarray:
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((k, 2 + k + n))
            for pdf in batches:
                total += _counted(list(pdf["ids"]), model, symbol, n)
            for i in range(k):
                at = np.flatnonzero(total[i])
                yield pd.DataFrame({"state": i, "at": at, "value": total[i, at]})

        parts = train.mapInPandas(count, "state int, at int, value double")
        # summed in a fixed order of rounded values, so that reruns agree
        sums = parts.groupBy("state", "at").agg(F.sum(F.col("value").cast("decimal(30,9)")).cast("double").alias("value")).toPandas()
        full = np.zeros((k, 2 + k + n))
        full[sums["state"].to_numpy(int), sums["at"].to_numpy(int)] = sums["value"].to_numpy(float)
        return full

    return _converged(over_all, model, unigram, tokens, TOLERANCE)


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Null text is read as empty: one token, the end. Documents whose crc32(doc_id as text) mod 7 is 2 are held out from
    training; a null doc_id never is. Rows that repeat a doc_id are scored each. Without training documents, every
    token is unknown: N and V are 0. Empty input: empty result.
    """
    counts = token_counts(docs)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"], total["v"]
    known, own = thresholds(counts, KNOWN - 1, VOCABULARY - 1)
    frequent = {r["word"]: r["c"] for r in counts.where((F.col("level") >= known) | (F.col("word") == END)).collect()}
    end = frequent.pop(END, 0)
    words = sorted(frequent, key=lambda w: (-frequent[w], w))
    n_own = counts.where((F.col("level") >= own) & (F.col("word") != END)).count()
    symbols = Symbols(words, n_own)
    length = F.least(F.length("word"), F.lit(CLASSES))
    others = counts.where((F.col("level") < own) & (F.col("word") != END))
    classes = {r["k"]: r["c"] + r["v"] for r in others.groupBy(length.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
    # a class has its words and one more for those never seen, each with one more count
    mass = [float(classes.get(k, 0) + 1) for k in range(1, CLASSES + 1)]
    weights = np.array([end + 1.0, *[frequent[w] + 1.0 for w in words[:n_own]], *mass])
    unigram = weights / weights.sum()

    table = encoded(docs, symbols)
    model = trained(table, symbols.symbol, unigram, n)
    base = math.log10(n + v + 1)
    plain = np.array([math.log10(x + 1) - base for x in (end, *[frequent[w] for w in words])])
    in_class = np.array([0.0] * (n_own + 1) + [math.log10(frequent[w] + 1) - math.log10(mass[min(len(w), CLASSES) - 1]) for w in words[n_own:]])
    unseen_end = end == 0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blobs = list(pdf.pop("ids"))
            likely, seen, based = [], [], []
            for r, a, b in _recursions(blobs, model, symbols.symbol):
                chains = r.likelihoods() / math.log(10)
                for blob, chain in zip(blobs[a:b], chains.tolist(), strict=True):
                    ids = np.frombuffer(blob, np.uint16)
                    ids = ids[ids < symbols.first_class]
                    seen.append(len(ids) - unseen_end)
                    based.append(math.fsum(plain[ids]))
                    likely.append(chain + math.fsum(in_class[ids]))
            yield pdf.assign(likely=likely, known=seen, based=based)

    local = table.select("row", "doc_id", "held_out", "n_tokens", "ids").mapInPandas(
        score, "row long, doc_id string, held_out boolean, n_tokens long, likely double, known long, based double")
    # the other words: each with its count where it has one
    rare = counts.where((F.col("level") < known) & (F.col("word") != END)).select("word", "c")
    found = table.where(F.col("rare") != "").select("row", F.explode(F.split("rare", " ")).alias("word")).groupBy("word", "row").agg(F.count(F.lit(1)).alias("tf"))
    share = F.array(*[F.lit(math.log10(m)) for m in mass])[length - 1]
    c = F.coalesce("c", F.lit(0))
    found = found.join(rare, "word", "left").select(
        "row", "tf", (F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"),
        (F.col("tf") * (F.log10(c + 1) - base)).alias("based"), (F.col("tf") * (F.log10(c + 1) - share)).alias("likely"))
    sums = found.groupBy("row").agg(F.sum("known").alias("known_rare"), F.sum("based").alias("based_rare"), F.sum("likely").alias("likely_rare"))
    out = local.join(sums, "row", "left")
    plus = lambda a: F.col(a) + F.coalesce(F.col(f"{a}_rare"), F.lit(0))
    return out.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens", plus("known").cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), plus("based").alias("base_score"), plus("likely").alias("score"))


def op3_hmm_scores(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
