"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector (seeded). A trigram is bound from its
letters' vectors, rotated by position and multiplied; a text is the bundle
(sum) of its trigrams' vectors, a language prototype the bundle of its training
texts. A text gets the language whose prototype has the largest cosine with it.

Both bundles are linear in the trigram counts, so the job carries counts, not
vectors: prototypes come from the summed counts per language, and the dot
product of a text with a prototype is the sum over its trigrams of the dot of
the trigram's vector with the prototype. Those dots form one table of
64^3 x languages numbers, whose size does not depend on the corpus. The text's
own length divides all its cosines alike.

``score`` is the share of the best cosine in the sum of the positive cosines,
0 to 1. Defined results: null text or text without a letter gives ``und`` and
0; with no usable training text every text is ``und`` with 0; ties go to the
first language in order; extra columns are ignored; repeated rows are
predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Symbols: 0 for all that is no letter, 1 to 26 for a to z, the rest for other letters.
SYMBOLS = 64
WIDTH = 2048
SEED = 11
UNKNOWN = "und"
#: Trigrams that a task holds before it counts them, beyond those of one text.
PENDING = 1 << 20
#: Rows of one message of counts.
SLICES = 64


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    """Symbol of each code point; letters are folded to lower case first."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x30000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (SYMBOLS - 27)
    out[0x30000:0x32000] = 27
    return out


def trigrams(text: str | None) -> np.ndarray:
    """Trigram numbers of a text; runs of other characters count as one gap."""
    if not text:
        return np.empty(0, np.int32)
    sym = _symbol_table()[np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)].astype(np.int32)
    sym = sym[np.concatenate(([True], (sym[1:] != 0) | (sym[:-1] != 0)))]
    if len(sym) < 3:
        return np.empty(0, np.int32)
    return (sym[:-2] * SYMBOLS + sym[1:-1]) * SYMBOLS + sym[2:]


def letter_vectors(width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (SYMBOLS, width))


def _trigram_block(first: int, letters: np.ndarray) -> np.ndarray:
    """Vectors of all trigrams that begin with symbol ``first``."""
    pairs = np.roll(letters, 1, axis=1)[:, None, :] * letters[None, :, :]
    return (np.roll(letters[first], 2) * pairs).reshape(SYMBOLS * SYMBOLS, -1)


def hypervector(text: str | None, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """The bundle of one text, spelled out; tests compare the table with it."""
    letters, out = letter_vectors(width, seed), np.zeros(width, np.float64)
    for number, count in zip(*np.unique(trigrams(text), return_counts=True)):
        a, b, c = number // SYMBOLS**2, number // SYMBOLS % SYMBOLS, number % SYMBOLS
        out += count * np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return out


def profile_table(counts: np.ndarray, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """Counts (languages x trigrams) -> dot of each trigram's vector with each unit prototype."""
    letters = letter_vectors(width, seed)
    blocks, size = range(SYMBOLS), SYMBOLS * SYMBOLS
    proto = sum(counts[:, f * size:(f + 1) * size].astype(np.float32) @ _trigram_block(f, letters) for f in blocks)
    proto /= np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
    return np.concatenate([_trigram_block(f, letters) @ proto.T for f in blocks]).astype(np.float32)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          width: int = WIDTH, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in order and their profile table, from all the labelled rows.

    Tasks add up trigram counts per language; what they send is one vector of
    64^3 counts per language, in ``SLICES`` pieces that are summed in the cluster.
    """
    step = SYMBOLS**3 // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        grams: dict[str, list[np.ndarray]] = {}
        pending = 0

        def add_up() -> None:
            for lang, parts in grams.items():
                counts = np.bincount(np.concatenate(parts), minlength=SYMBOLS**3)
                if lang in total:
                    total[lang] += counts
                else:
                    total[lang] = counts
            grams.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = trigrams(text.as_py())
                grams.setdefault(lang, []).append(found)
                pending += len(found)
                if pending > PENDING:
                    add_up()
                    pending = 0
        add_up()
        for lang, counts in total.items():
            for i in range(SLICES):
                part = counts[i * step:(i + 1) * step]
                at = np.flatnonzero(part)
                if len(at):
                    yield pa.RecordBatch.from_pydict(
                        {"lang": pa.array([lang] * len(at)), "gram": pa.array(at + i * step, pa.int32()),
                         "n": pa.array(part[at], pa.int64())})

    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "lang string, gram int, n long")
    sums = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.collect_list("gram").alias("grams"), F.collect_list("n").alias("ns")).orderBy("lang").toLocalIterator()
    langs, counts = [], []
    for row in sums:  # one row of at most 64^3 numbers per language
        one = np.zeros(SYMBOLS**3, np.float32)
        one[np.array(row["grams"])] = row["ns"]
        langs.append(row["lang"])
        counts.append(one)
    return langs, profile_table(np.stack(counts), width, seed) if langs else np.zeros((SYMBOLS**3, 0), np.float32)


def identify(docs: DataFrame, langs: list[str], profile: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text", carry: tuple[str, ...] = (), keep_text: bool = False, lettered: bool = False) -> DataFrame:
    """doc_id, the ``carry`` columns, lang_pred, score; one row per input row.

    ``keep_text`` carries the text too, ``lettered`` adds whether the text has a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profile)

    def predict(text: str | None) -> tuple[str, float, bool]:
        grams = trigrams(text)
        if not langs or not grams.any():
            return UNKNOWN, 0.0, bool(grams.any())
        dots = np.maximum(shared.value[grams].sum(axis=0, dtype=np.float64), 0)
        best = int(dots.argmax())
        return langs[best], float(dots[best] / dots.sum()) if dots[best] > 0 else 0.0, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[skip:], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                 *([pa.array([x[2] for x in found], pa.bool_())] if lettered else [])],
                names=[*batch.schema.names[skip:], "lang_pred", "score", *(["lettered"] if lettered else [])])

    skip = 0 if keep_text else 1
    slim = docs.select(F.col(text_col).alias("text" if keep_text else "_text"), F.col(id_col).alias("doc_id"), *carry)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[skip:])
    return slim.mapInArrow(run, f"{kinds}, lang_pred string, score double" + (", lettered boolean" if lettered else ""))


def held_out(id_col: str = "doc_id"):
    """The fold that training never sees: crc32 of the id as text leaves 1 over 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def language_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows outside the held-out fold, predict all: doc_id, held_out, lang_pred, score."""
    langs, profile = train(docs.where(~held_out(id_col)), text_col, lang_col)
    out = identify(docs, langs, profile, id_col, text_col)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
