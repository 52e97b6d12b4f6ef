"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's likelihood is the sum over all its segmentations into pieces of the
product of their probabilities, found by a forward recursion; a text's is the
product over its words. Piece probabilities are fitted by expectation
maximisation: expected counts over all segmentations of the training words,
summed in Spark, give the next probabilities.

A text is lower-cased and its words are the maximal runs of letters. The
likeliest language wins and its posterior under equal priors is the score.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text when there is nothing to learn from; ties go to the language
that sorts first; runs of over LONGEST letters are scored in parts of that
length; repeated rows give a row each; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows, importable
from veritrail.sources.scratch import materialise

#: Bound on the labelled rows learned from, for each language (on average).
TRAINING_ROWS = 1500
ROUNDS = 3
#: Count that every piece has in every language beforehand.
PRIOR = 0.02
#: Tasks that share the rounds of fitting, at most.
FITTED_IN = 12
#: Letters scored, and learned from, as one word at most.
LONGEST = 256
#: Words whose likelihood, or a part of it, falls below this are computed anew
#: with logarithms.
LEAST = 1e-250
#: Words whose likelihoods a worker keeps.
CACHED_WORDS = 120_000
LETTERS_AT_ONCE = 100_000
WORDS_AT_ONCE = 150_000
#: Languages that a model may have; more are an error, nothing is left out.
MAX_LANGUAGES = 500
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_START = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> list[str]:
    """Pieces of a public vocabulary, without its control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i))]


def words_of(text: str) -> list[str]:
    words = _WORD.findall(text.lower())
    if any(len(w) > LONGEST for w in words):
        return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


class Pieces:
    """Finds the pieces at every place of a word."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        plain = [(p, i) for i, p in enumerate(pieces) if not re.fullmatch("<0x..>", p)]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if re.fullmatch("<0x..>", p)}
        self.single = {p: i for p, i in plain if len(p) == 1}
        self.longest = max(len(p) for p, _ in plain)
        hashed = np.array([self._hash(p) for p, _ in plain], np.uint64)
        order = np.argsort(hashed)
        self.hashes = hashed[order]
        self.index = np.array([i for _, i in plain], np.int32)[order]

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h ^ ord(c)) * int(_STEP)) & (2**64 - 1)
            h ^= h >> 29
        return h

    def found(self, words: list[str]):
        """For words of one length, with the word start mark: by place and
        length the piece there, or ``size`` for none; and the words' letters."""
        text = "".join(_START + w for w in words)
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(words), -1)
        n = chars.shape[1]
        hashes = np.zeros((len(words), n), np.uint64)
        at = np.full((min(self.longest, n), len(words), n), self.size, np.int32)
        for k in range(1, len(at) + 1):
            ends = n - k + 1
            hashes = (hashes[:, :ends] ^ chars[:, k - 1 :].astype(np.uint64)) * _STEP
            hashes ^= hashes >> np.uint64(29)
            place = np.searchsorted(self.hashes, hashes)
            place[place == len(self.hashes)] = 0
            hit = self.hashes[place] == hashes
            at[k - 1, :, :ends][hit] = self.index[place[hit]]
        return at, chars

    def unknown(self, at: np.ndarray, chars: np.ndarray):
        """Places of letters that are no piece, with the pieces of their bytes."""
        rows, places = np.nonzero(at[0] == self.size)
        for row, place in zip(rows.tolist(), places.tolist()):
            raw = chr(int(chars[row, place])).encode("utf-8", "surrogatepass")
            yield row, place, [self.byte[b] for b in raw]


def by_length(words: list[str]):
    """Rows of words of one length, about LETTERS_AT_ONCE letters at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, rows in groups.items():
        step = max(1, LETTERS_AT_ONCE // (length + 1))
        for i in range(0, len(rows), step):
            yield rows[i : i + step]


def _log_forward(n: int, logs: np.ndarray, extra, back: bool = False) -> np.ndarray:
    """Logarithms of the sums over all segmentations up to (or, ``back``, from)
    each place. ``logs`` is (length - 1, word, start) and maybe language;
    ``extra`` (word, place, logarithm) of letters that are no piece."""
    out = np.full((n + 1, logs.shape[1], *logs.shape[3:]), -np.inf)
    out[n if back else 0] = 0
    spelled: dict[int, list] = {}
    for row, place, p in extra:
        spelled.setdefault(place, []).append((row, p))
    for i in range(1, n + 1):
        to = n - i if back else i
        for k in range(1, min(len(logs), i) + 1):
            start, other = (to, to + k) if back else (to - k, to - k)
            out[to] = np.logaddexp(out[to], out[other] + logs[k - 1, :, start])
        place, other = (to, to + 1) if back else (to - 1, to - 1)
        for row, p in spelled.get(place, ()):
            out[to, row] = np.logaddexp(out[to, row], out[other, row] + p)
    return out


def _logs(model: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(model)


def _exact_likelihoods(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    at, chars = pieces.found(words)
    extra = [(r, p, logs[raw].sum(axis=0)) for r, p, raw in pieces.unknown(at, chars)]
    n = chars.shape[1]
    return _log_forward(n, logs[at], extra)[n]


def _exact_counts(
    words: list[str], counts: np.ndarray, pieces: Pieces, logs: np.ndarray
) -> np.ndarray:
    at, chars = pieces.found(words)
    n = chars.shape[1]
    unknown = [(r, p, raw, logs[raw].sum()) for r, p, raw in pieces.unknown(at, chars)]
    extra = [(r, p, log) for r, p, _, log in unknown]
    share = logs[at]
    forward, backward = _log_forward(n, share, extra), _log_forward(n, share, extra, back=True)
    total = np.zeros(pieces.size + 1)
    for k in range(1, len(at) + 1):
        ends = n - k + 1
        used = np.exp(forward[:ends] + backward[k:] + share[k - 1, :, :ends].T - forward[n]) * counts
        total += np.bincount(at[k - 1, :, :ends].T.ravel(), used.ravel(), minlength=pieces.size + 1)
    for row, place, raw, log in unknown:
        used = np.exp(forward[place, row] + backward[place + 1, row] + log - forward[n, row])
        for i in raw:
            total[i] += used * counts[row]
    return total


def log_likelihoods(words: list[str], pieces: Pieces, model: np.ndarray) -> np.ndarray:
    """(word, language) logarithm of the sum over all segmentations. ``model``
    has a row for each piece and a last one of zeros, a column per language."""
    out = np.empty((len(words), model.shape[1]))
    logs = None
    for rows in by_length(words):
        at, chars = pieces.found([words[i] for i in rows])
        n, reach = chars.shape[1], len(at)
        extra: dict[int, list] = {}
        for row, place, raw in pieces.unknown(at, chars):
            extra.setdefault(place, []).append((row, np.prod(model[raw], axis=0)))
        forward = np.zeros((n + 1, len(rows), model.shape[1]))
        forward[0] = 1
        scale = np.zeros((len(rows), model.shape[1]))
        low = np.zeros(len(rows), bool)
        for end in range(1, n + 1):
            own = forward[end]
            for k in range(1, min(reach, end) + 1):
                own += forward[end - k] * model[at[k - 1, :, end - k]]
            for row, p in extra.get(end - 1, ()):
                own[row] += forward[end - 1, row] * p
            if end % 8 == 0 and end < n:
                # Keep the window that later places still read within range.
                window = forward[max(0, end - reach + 1) : end + 1]
                top = window.max(axis=0)
                low |= ~(window[-1] > LEAST * top).all(axis=1)
                top[top == 0] = 1
                window /= top
                scale += np.log(top)
        low |= ~(forward[n] > LEAST).all(axis=1)
        out[rows] = _logs(forward[n]) + scale
        if low.any():
            logs = _logs(model) if logs is None else logs
            for i in np.array(rows)[low]:
                out[i] = _exact_likelihoods([words[i]], pieces, logs)[0]
    return out


def expected_counts(
    words: list[str], counts: np.ndarray, pieces: Pieces, model: np.ndarray
) -> np.ndarray:
    """Expected number of uses of each piece in words of one language."""
    total = np.zeros(pieces.size + 1)
    for rows in by_length(words):
        at, chars = pieces.found([words[i] for i in rows])
        n, reach = chars.shape[1], len(at)
        share = model[at]
        extra = [(r, p, raw, np.prod(model[raw])) for r, p, raw in pieces.unknown(at, chars)]
        forward = np.zeros((n + 1, len(rows)))
        backward = np.zeros((n + 1, len(rows)))
        forward[0] = backward[n] = 1
        for end in range(1, n + 1):
            for k in range(1, min(reach, end) + 1):
                forward[end] += forward[end - k] * share[k - 1, :, end - k]
            for row, place, _, p in extra:
                if place == end - 1:
                    forward[end, row] += forward[place, row] * p
        for start in range(n - 1, -1, -1):
            for k in range(1, min(reach, n - start) + 1):
                backward[start] += backward[start + k] * share[k - 1, :, start]
            for row, place, _, p in extra:
                if place == start:
                    backward[start, row] += backward[start + 1, row] * p
        low = ~(forward[n] > LEAST)
        if low.any():
            own = np.array(rows)[low]
            total += _exact_counts([words[i] for i in own], counts[own], pieces, _logs(model))
        weight = np.where(low, 0, counts[rows] / np.where(low, 1, forward[n]))
        for k in range(1, reach + 1):
            ends = n - k + 1
            used = forward[:ends] * backward[k:] * share[k - 1, :, :ends].T * weight
            total += np.bincount(
                at[k - 1, :, :ends].T.ravel(), used.ravel(), minlength=pieces.size + 1
            )
        for row, place, raw, p in extra:
            used = forward[place, row] * backward[place + 1, row] * p * weight[row]
            for i in raw:
                total[i] += used
    return total[: pieces.size]


_vocabularies: dict[str, Pieces] = {}


def _vocabulary(path: str) -> Pieces:
    if path not in _vocabularies:
        _vocabularies[path] = Pieces(read_pieces(path))
    return _vocabularies[path]


def sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of each language at most, picked by hash."""
    counted = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages")
    if not counted:
        return labelled.where(F.lit(False))
    shares = F.create_map(*(F.lit(x) for lang, n in counted for x in (lang, rows / n)))
    spread = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) / 1_000_000.0
    return labelled.where(spread < shares[F.col("lang")])


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over the words, in parts as they are scored."""

    def work():
        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for w in words_of(text.as_py() or ""):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
            if not counts:
                return []
            langs, words = zip(*counts)
            return [{"lang": list(langs), "word": list(words), "n": list(counts.values())}]

        return step

    parts = arrow_rows(labelled.select("lang", "text"), work, "lang string, word string, n long")
    # A table of bounded size; many small parts would each meet every piece.
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n")).coalesce(FITTED_IN)


def _one_round(words: DataFrame, path: str, models: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    def work():
        pieces = _vocabulary(path)

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            langs = np.array(batch.column(0).to_pylist())
            texts = batch.column(1).to_pylist()
            counts = batch.column(2).to_numpy().astype(float)
            out = {"lang": [], "piece": [], "used": []}
            for lang in sorted(set(langs)):
                own = np.flatnonzero(langs == lang)
                used = expected_counts(
                    [texts[i] for i in own], counts[own], pieces, models[str(lang)]
                )
                hit = np.flatnonzero(used)
                out["lang"] += [str(lang)] * len(hit)
                out["piece"] += hit.tolist()
                out["used"] += used[hit].tolist()
            return [out]

        return step

    used = arrow_rows(words, work, "lang string, piece int, used double")
    totals = used.groupBy("lang", "piece").agg(F.sum("used").alias("used"))
    # Bounded by languages x vocabulary, whatever the number of rows.
    found = totals.collect()
    size = len(next(iter(models.values())))
    counts = {lang: np.full(size, PRIOR) for lang in models}
    for lang, piece, n in found:
        counts[lang][piece] += n
    return {lang: _distribution(c) for lang, c in counts.items()}


def _distribution(counts: np.ndarray) -> np.ndarray:
    counts[-1] = 0
    return counts / counts.sum()


def fit(
    labelled: DataFrame, path: str, rows: int = TRAINING_ROWS, rounds: int = ROUNDS
) -> dict[str, np.ndarray]:
    """Piece probabilities by language, from a bounded sample of ``labelled``
    (doc_id, lang, text). The last entry of each is 0, for no piece."""
    known = labelled.where("lang is not null")
    words = materialise(word_counts(sample(known, rows)), "language-words")
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())
    size = _vocabulary(path).size
    models = {lang: _distribution(np.ones(size + 1)) for lang in langs}
    for _ in range(rounds if langs else 0):
        models = _one_round(words, path, models)
    return models


class _Scorer:
    """Log-likelihoods of words, kept for those seen before."""

    def __init__(self, pieces: Pieces, model: np.ndarray):
        self.pieces, self.model = pieces, model
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.logs = np.empty((1024, self.model.shape[1]))

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """Summed log-likelihoods of each text's words."""
        new = list(set().union(*texts) - self.row.keys())
        if len(self.row) + len(new) > CACHED_WORDS and self.row:
            self.clear()
            new = list(set().union(*texts))
        if new:
            first = len(self.row)
            if first + len(new) > len(self.logs):
                grown = np.empty((2 * (first + len(new)), self.logs.shape[1]))
                grown[:first] = self.logs[:first]
                self.logs = grown
            self.logs[first : first + len(new)] = log_likelihoods(new, self.pieces, self.model)
            self.row.update(zip(new, range(first, first + len(new))))
        out = np.zeros((len(texts), self.logs.shape[1]))
        for i, words in enumerate(texts):
            if words:
                rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
                out[i] = self.logs[rows].sum(axis=0)
        return out


def _portions(texts, words: int):
    """Lists of texts with about ``words`` words in each."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= words:
            yield held
            held, n = [], 0
    if held:
        yield held


def predict(
    docs: DataFrame, models: dict[str, np.ndarray], path: str, text: str = "text"
) -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of these names."""
    langs = sorted(models)
    model = np.stack([models[x] for x in langs], axis=1) if langs else None
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    source = "_language_text"
    frame = docs.select(*(f"`{c}`" for c in kept), F.col(text).cast("string").alias(source))
    schema = docs.select(
        *(f"`{c}`" for c in kept),
        F.lit("").alias("lang_pred"),
        F.lit(0.0).alias("score"),
    ).schema

    def run(batches):
        import pyarrow as pa

        scorer = _Scorer(_vocabulary(path), model) if langs else None
        for batch in batches:
            if not batch.num_rows:
                continue
            preds, scores = [], []
            texts = (words_of(t.as_py() or "") for t in batch.column(source))
            for portion in _portions(texts, WORDS_AT_ONCE):
                totals = scorer.totals(portion) if scorer else None
                for i, words in enumerate(portion):
                    if totals is None or not has_letter(words):
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(totals[i].argmax())
                    preds.append(langs[best])
                    scores.append(float(1 / np.exp(totals[i] - totals[i][best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(preds), pa.array(scores)],
                names=schema.names,
            )

    return importable(frame).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
