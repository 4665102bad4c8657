"""Language identification with string kernels (operator 3).

Kernel: blended spectrum of character n-grams (n = 1..3) with presence
values, ``k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|)``.  Landmarks (a
sample of the training texts) give Nystroem features
``K(x, L) K(L, L)^(-1/2)``; one-versus-rest kernel ridge regression is solved
on them.  A task scores a text by the product of its presence vector with
the landmark weights.  Grams are told apart by their code points, so every
gram of the landmarks is a column, whatever the scripts.

Regression values of all languages sum to about one, so the best is high for
any text where there are few.  What is no language of the training texts is
found by familiarity instead: the share of a text's 3-grams (those without a
digit) that at least two training texts of the predicted language have.  It
must reach half of what is usual for training texts that are judged by the
others of their language, less three standard errors.

Bounds: ``per_lang`` training documents per language (the ones with the
smallest hash of their id) and ``landmarks`` of them; these, and nothing
else, reach the driver.  Scoring reads every whole text.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of

CHUNK = 1 << 20             # characters looked at together
ROWS = 256                  # documents of one result batch
ROWS_OF_VOCAB = 1 << 16     # grams of one matrix product in training
ASCII_LETTER = re.compile(r"[A-Za-z]")


def held_out(id_col) -> F.Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


class Grams:
    """Distinct n-grams (n = 1..3) of a text as sorted keys: code points + 1,
    21 bits each, so that no two grams share a key.

    ``alphabet``, the landmarks' characters, is only told: no other character
    is merged with another.
    """

    def __init__(self, alphabet: list[int] = ()):
        self.alphabet = alphabet

    def __call__(self, text: str) -> np.ndarray:
        codes, out = _codes(text), []
        for at in range(0, len(codes), CHUNK):
            s = codes[at:at + CHUNK + 2].astype(np.uint64) + np.uint64(1)   # two more: grams over the cut
            two = (s[:-1] << np.uint64(21)) | s[1:]
            out.append(_distinct(np.concatenate([s, two, (two[:-1] << np.uint64(21)) | s[2:]])))
        return out[0] if len(out) == 1 else _distinct(np.concatenate([*out, np.zeros(0, np.uint64)]))


def _columns(vocab: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of those keys that the sorted vocabulary has."""
    at = np.minimum(np.searchsorted(vocab, keys), len(vocab) - 1)
    return at[vocab[at] == keys]


def _threes(keys: np.ndarray) -> np.ndarray:
    """The 3-grams without an ASCII digit."""
    keys = keys[keys >> np.uint64(42) > 0]
    digit = np.zeros(len(keys), bool)
    for shift in (0, 21, 42):
        c = (keys >> np.uint64(shift)) & np.uint64((1 << 21) - 1)
        digit |= (c > ord("0")) & (c <= ord("9") + 1)            # code points + 1
    return keys[~digit]


def _usual(sets: list[np.ndarray]) -> np.ndarray:
    """Grams of at least two of the sets."""
    keys, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
    return keys[n >= 2]


def _share(keys: np.ndarray, known: np.ndarray) -> float:
    return len(_columns(known, keys)) / len(keys) if len(known) and len(keys) else 0.0


def _familiar(sets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Usual 3-grams of a language's texts, and the share a text must have:
    half the median of either half of the texts under the other."""
    halves = sets[::2], sets[1::2]
    seen = [_share(g, known) for known, judged in zip(map(_usual, halves), halves[::-1])
            for g in judged if len(g)]
    return _usual(sets), float(np.median(seen)) / 2 if seen else 0.0


def _strange(keys: np.ndarray, known: np.ndarray, least: float) -> bool:
    keys = _threes(keys)
    return bool(len(keys)) and _share(keys, known) < least - 3 * np.sqrt(
        least * (1 - least) / len(keys))


def fit(docs: DataFrame, per_lang: int = 120, landmarks: int = 160, ridge: float = 1e-3
        ) -> dict | None:
    """Model from the rows that are not held out and have a language.

    ``docs``: doc_id, text, lang.  None where there is no training row.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = (docs.where(~held_out("doc_id") & F.col("lang").isNotNull()
                         & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
              .select("doc_id", "text", "lang")
              .withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= per_lang).orderBy("rank", "lang").collect())
    sample = [r for r in sample if has_letter(r["text"])]
    if not sample:
        return None
    langs = sorted({r["lang"] for r in sample})
    alphabet = np.unique(np.concatenate([_codes(r["text"]) for r in sample[:landmarks]]))
    grams = Grams(alphabet.tolist())
    sets = [grams(r["text"]) for r in sample]
    marks = sets[:landmarks]                     # rank order: languages in turn
    vocab = np.unique(np.concatenate(marks))
    has = np.zeros((len(vocab), len(marks)), bool)
    for j, g in enumerate(marks):
        has[np.searchsorted(vocab, g), j] = True
    norm = np.sqrt([len(g) for g in marks])
    kernel = np.array([has[_columns(vocab, g)].sum(0) / np.sqrt(len(g)) for g in sets]) / norm
    values, vectors = np.linalg.eigh(kernel[:len(marks)])
    good = values > 1e-8 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])          # K(L, L)^(-1/2)
    phi = np.hstack([kernel @ root, np.ones((len(sets), 1))])
    target = np.array([[r["lang"] == c for c in langs] for r in sample], float)
    beta = np.linalg.solve(phi.T @ phi + ridge * len(sets) * np.eye(phi.shape[1]),
                           phi.T @ target)
    each = (root @ beta[:-1]) / norm[:, None]                # of a landmark's every gram
    weights = np.concatenate([has[i:i + ROWS_OF_VOCAB] @ each
                              for i in range(0, len(vocab), ROWS_OF_VOCAB)])
    return {"langs": langs, "alphabet": grams.alphabet, "vocab": vocab,
            "weights": weights, "bias": beta[-1],
            "familiar": [_familiar([_threes(g) for g, r in zip(sets, sample) if r["lang"] == c])
                         for c in langs]}


def _values(m: dict, keys: np.ndarray) -> np.ndarray:
    """Regression values of a text with these grams."""
    return m["weights"][_columns(m["vocab"], keys)].sum(0) / np.sqrt(len(keys)) + m["bias"]


def predict(docs: DataFrame, model: dict | None, carry: tuple[str, ...] = ("doc_id",),
            reject: bool = False) -> DataFrame:
    """``carry`` columns of ``docs`` plus ``lang_pred, score`` for every row.

    The prediction reads only ``text``.  ``und`` with score 0 for a null or
    empty text, a text without a letter, or a model without training rows.
    The score is the winner's regression value cut to 0..1; equal values go
    to the language first in order.  With ``reject`` a text that is not
    familiar in the predicted language is ``und`` with score 0, too.  Rows are kept as they are, repeats too;
    a carried column named like an output is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    carry = [c for c in carry if c not in ("lang_pred", "score")]
    kept = docs.select(*carry).schema
    schema = kept.add("lang_pred", "string").add("score", "double")
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # grams of the landmarks

    def run(batches):
        m = shared.value
        if m:
            grams = Grams(m["alphabet"])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(part.num_columns - 1).to_pylist()
                label, score = ["und"] * len(texts), np.zeros(len(texts))
                rows = [i for i, t in enumerate(texts) if has_letter(t)]
                if m and rows:
                    keys = [grams(texts[i]) for i in rows]
                    f = np.round([_values(m, g) for g in keys], 6)
                    best = f.argmax(1)
                    score[rows] = np.clip(f[np.arange(len(rows)), best], 0, 1)
                    for i, b, g in zip(rows, best, keys):
                        if reject and _strange(g, *m["familiar"][b]):
                            score[i] = 0
                        else:
                            label[i] = m["langs"][b]
                yield batch_of(arrow, *[part.column(i) for i in range(len(carry))],
                               label, score)

    return docs.select(*carry, F.col("text").alias("text__")).mapInArrow(run, schema)
