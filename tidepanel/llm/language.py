"""Language identification by scripts, character trigrams and Viterbi over words.

A word's script narrows the languages that it may be; each of them scores the word by its
trigrams; the best path over a document's words, with a penalty for each switch, labels spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import rows_of

# First and last code points of Unicode blocks by script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
UNKNOWN = "und"
BUCKETS = 1 << 18  # of trigrams, by hash: the model has this many numbers a language

_letters: list[np.ndarray] = []


def script_table() -> np.ndarray:
    """For each code point 0 (no letter), 1 (a letter of another script) or 2 + its script."""
    if not _letters:
        table = np.zeros(0x110000, np.uint8)
        table[[i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = 1
        for k, ranges in enumerate(SCRIPTS.values()):
            for a, b in ranges:
                table[a : b + 1][table[a : b + 1] > 0] = 2 + k
        _letters.append(table)
    return _letters[0]


class Words:
    """The words (runs of letters) of some texts, as arrays over all their letters."""

    def __init__(self, texts: list[str | None]):
        codes = [np.frombuffer((t or "").lower().encode("utf-32-le", "replace"), "<u4") for t in texts]
        space = np.array([32], np.uint32)
        flat = np.concatenate([space, *(x for c in codes for x in (c, space))])
        script = script_table()[flat]
        letter = script > 0
        at = np.flatnonzero(letter)
        first = at[~letter[at - 1]] if len(at) else at
        codes_of = np.where(letter, flat, np.uint32(0))
        with np.errstate(over="ignore"):
            mixed = (codes_of[at - 1] * np.uint32(0x9E3779B1)) ^ (codes_of[at] * np.uint32(0x85EBCA6B) + np.uint32(1))
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35) ^ (codes_of[at + 1] * np.uint32(0x27D4EB2F))
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x165667B1)
        self.bucket = ((mixed ^ (mixed >> np.uint32(16))) & np.uint32(BUCKETS - 1)).astype(np.int32)
        self.start = np.searchsorted(at, first)  # of each word, among the letters
        self.length = np.diff(np.append(self.start, len(at)))
        self.script = script[first]
        ends = np.cumsum([len(c) + 1 for c in codes])
        self.per_text = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))

    def scores(self, table: np.ndarray, step: int = 1 << 16) -> np.ndarray:
        """The sum of each word's trigram scores, a row a word and a column a language."""
        out = np.zeros((len(self.start), table.shape[1]), np.float32)
        for a in range(0, len(self.bucket), step):
            b = min(a + step, len(self.bucket))
            w0 = np.searchsorted(self.start, a, "right") - 1
            cuts = self.start[w0 : np.searchsorted(self.start, b)] - a
            cuts[0] = 0
            out[w0 : w0 + len(cuts)] += np.add.reduceat(table[self.bucket[a:b]], cuts, axis=0)
        return out


def viterbi(scores: np.ndarray, per_text: np.ndarray, penalty: float) -> np.ndarray:
    """The label of each word on its text's best path; all texts advance together."""
    order = np.argsort(-per_text, kind="stable")
    starts = (np.cumsum(per_text) - per_text)[order]
    lengths = per_text[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), "right")
    jump, origin = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    for t, n in enumerate(active):
        at = starts[:n] + t
        if t:
            top = best[:n].argmax(1)
            other = best[np.arange(n), top] - penalty
            leave = other[:, None] > best[:n]
            jump[at], origin[at] = leave, top
            best[:n] = np.where(leave, other[:, None], best[:n])
        best[:n] += scores[at]
        best[:n] -= best[:n].max(1, keepdims=True)
    label = np.zeros(len(scores), np.int16)
    state = np.zeros(len(order), np.int16)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        ended = lengths[:n] == t + 1
        state[:n][ended] = best[:n][ended].argmax(1)
        label[at] = state[:n]
        state[:n] = np.where(jump[at, state[:n]], origin[at], state[:n])
    return label


class Model:
    """Trigram scores and scripts of each language; ``BUCKETS`` x languages numbers."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = counts.sum(0, keepdims=True)
        spread = np.maximum((counts.sum(1) > 0).sum(), 1)
        self.table = np.log((counts + 0.1) / (total + 0.1 * spread)).astype(np.float32)
        self.allowed = scripts >= 0.01 * np.maximum(scripts.sum(1, keepdims=True), 1)  # language x script

    def word_scores(self, found: Words) -> np.ndarray:
        scores = found.scores(self.table)
        allowed = self.allowed.T[found.script]
        scores[~allowed & allowed.any(1, keepdims=True)] = -1e4
        return scores


def fit(documents: DataFrame, max_docs: int = 5_000, max_languages: int = 512) -> Model:
    """Learn from (text, lang); rows without either are passed over.

    More than ``max_languages`` values of ``lang`` are an error, raised before anything is learned: a
    language takes a megabyte in every task, and so many mean that the column holds something else.

    At most about ``max_docs`` documents of each language, chosen by a hash of their text, teach
    the trigrams; the numbers of documents a language are counted over all rows.
    """
    spark = documents.sparkSession
    usable = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    found = usable.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages: is lang a language column?")
    known = {r["lang"]: r["n"] for r in found}
    languages = sorted(known)
    share = F.lit(0)
    for lang, n in known.items():
        share = F.when(F.col("lang") == lang, int(min(1.0, max_docs / n) * (1 << 30))).otherwise(share)
    sample = usable.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share) if known else usable

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {lang: k for k, lang in enumerate(languages)}
        trigrams = np.zeros(BUCKETS * len(languages), np.int64)
        scripts = np.zeros((len(languages), 256), np.int64)
        for batch in rows_of(batches, 64):
            langs = batch.column(0).to_pylist()
            for lang in set(langs):
                own = Words([t for g, t in zip(langs, batch.column(1).to_pylist()) if g == lang])
                np.add.at(trigrams, own.bucket.astype(np.int64) * len(languages) + place[lang], 1)
                scripts[place[lang]] += np.bincount(own.script, minlength=256)
        where = np.flatnonzero(trigrams)
        lang, script = np.nonzero(scripts)
        key = np.concatenate([where, -1 - (lang * 256 + script)])
        n = np.concatenate([trigrams[where], scripts[lang, script]])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    counts = np.zeros(BUCKETS * max(1, len(languages)))
    scripts = np.zeros((len(languages), 256))
    if languages:
        rows = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
        key, n = rows["key"].to_numpy(), rows["n"].to_numpy()
        counts[key[key >= 0]] = n[key >= 0]
        scripts.reshape(-1)[-1 - key[key < 0]] = n[key < 0]
    del spark
    return Model(languages, counts.reshape(BUCKETS, -1)[:, : len(languages)], scripts)


def identify(documents: DataFrame, model: Model, penalty: float = 12.0, with_spans: bool = True) -> DataFrame:
    """All columns, and lang_pred, score and spans (first word, words, language).

    ``lang_pred`` has the most letters on the best path, ``score`` is its share of the letters;
    a text that is null or has no letter is ``und`` with score 0, and so is every text if the
    model knows no language. Ties go to the language first in order. Former columns of these
    names are replaced; repeated rows are each returned; an empty table gives no rows. A text is taken
    whole, however long: its path takes some 100 bytes a word and language. Nothing is shuffled.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages x 4 bytes
    names = [c for c in documents.columns if c not in ("lang_pred", "score", "spans")]
    place = names.index("text")

    def label(texts: list[str | None]) -> tuple[list, list, list]:
        own = shared.value
        preds, scores, spans = [], [], []
        found = Words(texts) if own.languages else None
        labels = viterbi(own.word_scores(found), found.per_text, penalty) if found else None
        ends = np.cumsum(found.per_text).tolist() if found else [0] * len(texts)
        a = 0
        for b in ends:
            if a == b:
                preds.append(UNKNOWN), scores.append(0.0), spans.append([])
                continue
            own_labels, letters = labels[a:b], found.length[a:b]
            weight = np.bincount(own_labels, letters, len(own.languages))
            top = int(weight.argmax())
            preds.append(own.languages[top]), scores.append(float(weight[top] / weight.sum()))
            if with_spans:
                cut = np.concatenate([[0], np.flatnonzero(np.diff(own_labels)) + 1, [b - a]])
                spans.append([{"first": int(i), "words": int(j - i), "lang": own.languages[own_labels[i]]} for i, j in zip(cut, cut[1:])])
            a = b
        return preds, scores, spans

    kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def groups(batch: pa.RecordBatch, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
        sizes, a, held = [len(t or "") for t in batch.column(place).to_pylist()], 0, 0
        for b, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(a, b - a)
                a, held = b, 0
            held += n
        yield batch.slice(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in rows_of(batches, 4096):
            for batch in groups(large):
                preds, scores, spans = label(batch.column(place).to_pylist())
                arrays = [*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
                if with_spans:
                    arrays.append(pa.array(spans, kind))
                yield pa.RecordBatch.from_arrays(arrays, [*names, "lang_pred", "score", *["spans"] * with_spans])

    kept = documents.select(*[F.col(f"`{c}`") for c in names])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema += ", lang_pred string, score double" + ", spans array<struct<first:int,words:int,lang:string>>" * with_spans
    return kept.mapInArrow(run, schema)
