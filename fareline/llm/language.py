"""Language identification: averaged hashed subword embeddings and a linear softmax.

Letters are lower-cased, all else becomes a space, and every run of two to four bytes
that doesn't cross a word border is a subword. Subwords are hashed to rows of one
embedding table; a text is the average of its rows, and a softmax over a linear layer
gives the languages. Training is stochastic gradient descent in numpy on a bounded
sample; a held-out part of the sample sets a temperature, so that scores are
probabilities, and the score under which a text is rejected. Rows that training never
touched are zero, so texts in an unknown script fall towards an even, low score.

A text is rejected as well if training met too few of its subwords. How many is enough is
calibrated by length on the held-out part, each language left out in turn: there, the
share of subwords that its own training texts or others have met is set against the share
that only the other languages have met, which is how an unlearned language looks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import map_columns

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
WIDTH = 8
EPOCHS = 4
RATE = 4.0
#: The training sample: documents a language, languages, and bytes of a document; longer
#: documents are left out of the sample, never cut.
DOCS_A_LANGUAGE, MOST_LANGUAGES, LONGEST = 500, 200, 30_000
#: Share of texts that the sample's held-out part may reject.
REJECTED = 0.0005
#: The least score is never set above this.
LEAST_SCORE = 0.4
#: The share of known subwords that is asked for at most, by length class: short texts hold a rare name or
#: number more easily. And how many pieces are enough to calibrate a class.
LEAST_SEEN, ENOUGH = (0.5, 0.6, 0.7, 0.8, 0.8, 0.8), 30
#: Lengths are told apart by their binary digits, in subwords: under 64, 128, ... 1024, and all longer ones.
SHORTEST_CLASS, CLASSES = 6, 6
#: Words of further pieces that only calibrate, so that every class has some.
HELD_WORDS = (6, 25, 50, 100)
#: Which quantile of the left-out languages' shares counts as unlearned.
UNLEARNED = 0.9

_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every subword of folded bytes, for all orders."""
    space = data == 32
    wide = data.astype(np.uint32)
    rows, places = [], []
    for n, order in enumerate(ORDERS):
        size = len(data) - order + 1
        if size <= 0:
            continue
        hashed = np.full(size, 2166136261 + n, np.uint32)
        for at in range(order):
            hashed = (hashed ^ wide[at : at + size]) * np.uint32(16777619)
        inside = np.zeros(size, bool)
        for at in range(1, order - 1):
            inside |= space[at : at + size]
        inside |= space[:size] & space[order - 1 :]
        kept = np.flatnonzero(~inside)
        hashed = hashed[kept]
        rows.append(((hashed ^ (hashed >> np.uint32(15))) % np.uint32(BUCKETS)).astype(np.int32) + n * BUCKETS)
        places.append(kept)
    if not rows:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(places)


def length_class(count: int) -> int:
    return min(max(count.bit_length() - SHORTEST_CLASS, 0), CLASSES - 1)


def folded(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "surrogatepass").translate(_FOLD) + b" "


@dataclass
class LanguageModel:
    """Languages, logits of each subword row and whether training met it, temperature, and the
    least score and, by length class, share of known subwords of a text that is accepted."""

    languages: list[str]
    logits: np.ndarray
    seen: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: tuple[float, ...] = (0.0,) * CLASSES

    def raw(self, text: str) -> tuple[np.ndarray, float, int]:
        """Averaged logits, known share and count of a text's subwords, a piece of a megabyte at a time."""
        data = np.frombuffer(folded(text), np.uint8)
        total, count, seen = np.zeros(len(self.languages)), 0, 0
        longest = max(ORDERS)
        for start in range(0, len(data), 1 << 20):
            piece = data[start : start + (1 << 20) + longest - 1]
            rows, places = subwords(piece)
            rows = rows[places < (1 << 20)]
            for part in range(0, len(rows), 1 << 18):
                total += self.logits[rows[part : part + (1 << 18)]].sum(axis=0, dtype=np.float64)
            count += len(rows)
            seen += int(self.seen[rows].sum())
        return total / max(1, count), seen / max(1, count), count

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether the text is accepted."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        raw, seen, count = self.raw(text)
        p = _softmax(raw / self.temperature)
        best = int(p.argmax())
        accepted = p[best] >= self.least_score and seen >= self.least_seen[length_class(count)]
        return self.languages[best], float(p[best]), bool(accepted)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], langs: list[str], seed: int = 7) -> LanguageModel:
    """SGD over whole texts and short pieces of them; every fifth text calibrates."""
    languages = sorted(set(langs))
    if len(languages) < 2:
        rows = len(ORDERS) * BUCKETS
        return LanguageModel(languages, np.zeros((rows, len(languages))), np.zeros(rows, bool))
    rng, places = np.random.default_rng(seed), np.random.default_rng(seed + 1)
    examples, held = [], []
    for n, i in enumerate(rng.permutation(len(texts))):
        text, y = texts[i], languages.index(langs[i])
        words = text.split(" ")
        pieces = [text]
        for length in (3, 12):
            if len(words) > length:
                at = int(rng.integers(len(words) - length))
                pieces.append(" ".join(words[at : at + length]))
        for length in HELD_WORDS if n % 5 == 0 else ():
            if len(words) > length:
                at = int(places.integers(len(words) - length))
                pieces.append(" ".join(words[at : at + length]))
        for piece in pieces:
            rows, counts = np.unique(subwords(np.frombuffer(folded(piece), np.uint8))[0], return_counts=True)
            if len(rows):
                (held if n % 5 == 0 else examples).append((rows, counts / counts.sum(), y, piece))
    table = rng.uniform(-1, 1, (len(ORDERS) * BUCKETS, WIDTH)) / WIDTH
    layer = np.zeros((WIDTH, len(languages)))
    met = np.zeros((len(languages), len(table)), bool)
    for rows, _, y, _ in examples:
        met[y, rows] = True
    touched = met.any(axis=0)
    steps = EPOCHS * len(examples)
    step = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            rows, weights, y, _ = examples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = weights @ table[rows]
            error = _softmax(hidden @ layer)
            error[y] -= 1
            back = layer @ error
            layer -= rate * 0.1 * np.outer(hidden, error)
            table[rows] -= rate * len(rows) ** 0.5 * weights[:, None] * back[None, :]
    table[~touched] = 0
    model = LanguageModel(languages, (table @ layer).astype(np.float32), touched)
    if held:
        found = [model.raw(piece) for _, _, _, piece in held]
        raw = np.array([x for x, _, _ in found])
        y = np.array([y for _, _, y, _ in held])
        losses = {}
        for t in np.geomspace(0.05, 5, 40):
            p = _softmax(raw / t)[np.arange(len(y)), y]
            losses[t] = -np.log(np.maximum(p, 1e-12)).mean()
        model.temperature = float(min(losses, key=losses.get))
        scores = _softmax(raw / model.temperature).max(axis=1)
        model.least_score = float(min(np.quantile(scores, REJECTED), max(LEAST_SCORE, 1.2 / len(languages))))
        languages_met = met.sum(axis=0)
        foreign = [float(weights @ (languages_met[rows] > met[y, rows])) for rows, weights, y, _ in held]
        model.least_seen = least_shares([x for _, x, _ in found], foreign, [n for _, _, n in found])
    return model


def least_shares(own: list[float], foreign: list[float], counts: list[int]) -> tuple[float, ...]:
    """The least known share by length class, from pieces' shares with and without their language.

    It lies half-way between the two where they are apart, and rejects no more than REJECTED
    of the pieces where they aren't: never above LEAST_SEEN, which stands alone where pieces
    are too few. No class asks for more than a longer one.
    """
    classes, own, foreign = np.array([length_class(n) for n in counts]), np.array(own), np.array(foreign)
    shares = list(LEAST_SEEN)
    for k in range(CLASSES):
        inside = classes == k
        if inside.sum() >= ENOUGH:
            low, high = np.quantile(own[inside], REJECTED), np.quantile(foreign[inside], UNLEARNED)
            shares[k] = min(shares[k], float((low + high) / 2 if high < low else low))
    return tuple(min(shares[k:]) for k in range(CLASSES))


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model from at most DOCS_A_LANGUAGE documents of each language, none of them held out."""
    learn = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    learn = learn.where(F.octet_length(text_col) <= LONGEST)
    counts = learn.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MOST_LANGUAGES).collect()
    if not counts:
        return LanguageModel([], np.zeros((1, 0)), np.zeros(1, bool))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], DOCS_A_LANGUAGE / r[1])])[F.col(lang_col)]
    drawn = (F.xxhash64(F.col(id_col).cast("string"), F.lit("language")) / F.lit(2.0**64)) + 0.5
    sample = learn.where(drawn < share).select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = sample.limit(DOCS_A_LANGUAGE * len(counts) * 2).collect()
    rows = sorted(rows, key=lambda r: (r.l, r.t))
    return train([r.t for r in rows], [r.l for r in rows])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs and lang_pred, lang_score (0 to 1), lang_accepted.

    The whole text decides; null texts and texts without letters are `und`, score 0, not
    accepted. Columns of docs with those three names are replaced. Repeated rows give
    repeated results; null ids are kept.
    """
    added = ["lang_pred", "lang_score", "lang_accepted"]
    docs = docs.select([c for c in docs.columns if c not in added])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{n}` {k}" for n, k in docs.dtypes) + ", lang_pred string, lang_score double, lang_accepted boolean"
    place = docs.columns.index(text_col)

    def make():
        def work(*columns: list) -> list[list]:
            found = [shared.value.predict(text) for text in columns[place]]
            return [*columns, [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]]

        return work

    return map_columns(docs, docs.columns, schema, make)
