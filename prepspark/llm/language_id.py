"""Language ID: scripts narrow the candidates, Viterbi labels spans of mixed texts.

Learning counts hashed character n-grams (orders 1 to 4, with word ends) per language, and
letters per script and language, over a sample of about ``train_rows`` labelled rows of each
language at most, chosen by a hash of the id; the model has ``2 ** GRAM_BITS`` numbers a language,
whatever the corpus.  A word's score in a language is the sum of its n-grams' log
likelihoods; languages without a share of ``MIN_SHARE`` of their letters in the word's
script are no candidates.  Viterbi over a text's words pays ``penalty`` for each change of
language; the texts of a batch take each step together.  The language with most letters in
its spans is predicted, and its share of the letters is the score.

Prediction reads the text only and needs no shuffle.  Learning shuffles counts that each
task has summed up.

A word is a run of letters of one script with the marks that combine with them, so that words of
Hindi and Thai stay whole and a change of script inside unspaced text is a change of word.

Results for odd input: a null text or one without letters is ``und`` with score 0; without
labelled rows every text is ``und``, and the filter keeps those with a letter; null, repeated ids and repeated rows are passed on row by
row; extra columns are ignored; ties go to the smaller language code; an empty table gives an
empty result.  Texts are read whole; the longest one bounds a batch's memory.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, query, releasing, slices, table

GRAM_BITS = 15
MIN_SHARE = 1e-3
CACHED_WORDS = 100_000
CELLS = 2_000_000
ROWS = 512
UNKNOWN = "und"
SAMPLE_SPACE = 1 << 62

#: First code points of script ranges, in order; a range ends where the next one starts.
SCRIPTS = [
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x700, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xB80, "tamil"), (0xC00, "other"),
    (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB07, "other"), (0x20000, "han"),
]
_STARTS = [s for s, _ in SCRIPTS]
_LAST = 0x32400  # no letters from here on


def _word_pattern() -> str:
    """Letters of one script with the marks that combine with them; a word ends where the script changes."""
    letters, marks = {}, {name: [(0x300, 0x36F)] for _, name in SCRIPTS}
    for (first, name), end in zip(SCRIPTS, [*_STARTS[1:], _LAST]):
        for code in range(first, end):
            kind = unicodedata.category(chr(code))[0]
            for found in ([letters.setdefault(name, [])] if kind == "L" else []) + ([marks[name]] if kind in "LM" else []):
                if found and found[-1][1] == code - 1:
                    found[-1] = (found[-1][0], code)
                else:
                    found.append((code, code))

    def chars(ranges) -> str:
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)

    every = chars([r for own in letters.values() for r in own])
    return f"(?=[{every}])(?:" + "|".join(f"[{chars(letters[n])}][{chars(marks[n])}]*" for n in letters) + ")"


_WORDS = re.compile(_word_pattern())


def script_of(word: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all n-grams of the words."""
    code = np.frombuffer(("\1" + "\1".join(words) + "\1").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    end = code == 1
    number = np.cumsum(end) - 1
    at, bucket = [], []
    mixed, inner = code * np.uint64(0x9E3779B97F4A7C15), np.zeros(len(code), bool)
    for n in range(1, 5):
        size = len(code) - n + 1
        if size <= 0:
            break
        if n > 1:
            mixed = (mixed[:size] ^ code[n - 1 :]) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            inner = inner[:size] | end[n - 2 : n - 2 + size] if n > 2 else np.zeros(size, bool)
        ok = ~end if n == 1 else ~inner
        first = np.nonzero(ok)[0]
        at.append(number[first])  # an end mark counts with the word after it
        bucket.append(((mixed[first] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS))
    at, bucket = np.concatenate(at), np.concatenate(bucket).astype(np.int64)
    keep = at < len(words)
    return at[keep], bucket[keep]


@dataclass
class LanguageModel:
    """Log likelihoods of buckets per language and the candidates of each script."""

    langs: list[str]
    logp: np.ndarray
    scripts: dict[str, np.ndarray]
    penalty: float = 12.0
    known: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    letters: np.ndarray | None = None

    def learn_words(self, words: list[str]) -> None:
        """Add rows of scores for words that the cache does not have."""
        if self.scores is None or len(self.known) + len(words) > CACHED_WORDS:
            self.known.clear()
            self.scores, self.letters = np.zeros((0, len(self.langs)), np.float32), np.zeros(0, np.int64)
        plain = [w.lower() for w in words]
        at, bucket = _grams(plain)
        rows = np.stack([np.bincount(at, self.logp[k][bucket], len(words)) for k in range(len(self.langs))], 1)
        for i, w in enumerate(plain):
            if (out := self.scripts.get(script_of(w))) is not None:
                rows[i, out] -= 1e4
        start = len(self.scores)
        self.known.update(zip(words, range(start, start + len(words))))
        self.scores = np.concatenate([self.scores, rows.astype(np.float32)])
        self.letters = np.concatenate([self.letters, np.array([len(w) for w in plain], np.int64)])

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, spans) of each text."""
        out, part, cells = [], [], 0
        for i, text in enumerate(texts):
            part.append(text)
            cells += len(text or "") // 4 * max(1, len(self.langs))
            if cells > CELLS or i == len(texts) - 1:
                out += self._label(part)
                part, cells = [], 0
        return out

    def _label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        if not self.langs:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        words = [_WORDS.findall(t) if t else [] for t in texts]
        every = set().union(*words) if words else set()
        new = [w for w in every if w not in self.known]
        if self.scores is None or len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            self.scores, new = None, sorted(every)
        if new or self.scores is None:
            self.learn_words(sorted(new))
        # Longest first: the texts that still have a word at step t are a prefix.
        order = sorted(range(len(texts)), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in order])
        offset = np.concatenate([[0], np.cumsum(sizes)])
        total, n = int(offset[-1]), len(self.langs)
        index = np.fromiter((self.known[w] for i in order for w in words[i]), np.int64, total)
        letters = self.letters[index] if total else np.zeros(0, np.int64)
        steps = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(steps), "left")  # texts with more than t words
        back = np.zeros((total, n), np.uint8 if n < 256 else np.uint16)
        value = np.zeros((len(texts), n))
        own = np.arange(n)
        for t in range(steps):
            a = alive[t]
            at = offset[:a] + t
            v = value[:a]
            if t:
                best = v.argmax(axis=1)
                change = v[np.arange(a), best] - self.penalty
                moved = v < change[:, None]
                back[at] = np.where(moved, best[:, None], own)
                v = np.where(moved, change[:, None], v)
            value[:a] = v + self.scores[index[at]]
        label = np.zeros(total, np.int64)
        state = value.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            a = alive[t]
            at = offset[:a] + t
            label[at] = state[:a]
            state[:a] = back[at, state[:a]]
        owner = np.repeat(np.arange(len(texts)), sizes)
        share = np.bincount(owner * n + label, letters, len(texts) * n).reshape(len(texts), n)
        result: list = [None] * len(texts)
        for k, i in enumerate(order):
            all_letters = share[k].sum()
            if not all_letters:
                result[i] = (UNKNOWN, 0.0, [])
                continue
            best = int(share[k].argmax())
            mine = label[offset[k] : offset[k + 1]]
            if (mine == mine[0]).all():
                spans = [{"start": 0, "end": len(texts[i]), "lang": self.langs[best]}]
            else:
                starts = [m.start() for m in _WORDS.finditer(texts[i])]
                cuts = [0, *(np.nonzero(np.diff(mine))[0] + 1).tolist()]
                bounds = [0, *(starts[c] for c in cuts[1:]), len(texts[i])]
                spans = [
                    {"start": bounds[j], "end": bounds[j + 1], "lang": self.langs[mine[c]]} for j, c in enumerate(cuts)
                ]
            result[i] = (self.langs[best], float(share[k][best] / all_letters), spans)
        return result


def sampled_below(rows: int, wanted: int) -> int:
    """Of hashes below ``SAMPLE_SPACE``, those below this pick about ``wanted`` of ``rows`` rows; never none."""
    return max(1, SAMPLE_SPACE * wanted // max(rows, 1))


def fit_languages(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  train_rows: int = 5_000, penalty: float = 12.0) -> LanguageModel:
    """Model from rows with a language; of a language with more than ``train_rows`` about so many, picked by a hash of the id."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    large = {lang: sampled_below(n, train_rows) for lang, n in counts.items() if n > train_rows}
    picked = rows
    if large:
        below = F.element_at(F.create_map(*[F.lit(v) for pair in large.items() for v in pair]), F.col("lang"))
        picked = rows.where(F.coalesce(F.pmod(F.xxhash64("id"), F.lit(SAMPLE_SPACE)) < below, F.lit(True)))

    def run(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: Counter = Counter()
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = Counter(w.lower() for w in _WORDS.findall(text))
                if not counts:
                    continue
                at, bucket = _grams(list(counts))
                times = np.array(list(counts.values()), np.float64)
                grams.setdefault(lang, np.zeros(1 << GRAM_BITS))
                grams[lang] += np.bincount(bucket, times[at], 1 << GRAM_BITS)
                for w, k in counts.items():
                    scripts[lang, script_of(w)] += k * len(w)
        for lang, row in grams.items():
            at = np.nonzero(row)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array([""] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(row[at])],
                ["lang", "script", "bucket", "n"],
            )
        if scripts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in scripts], pa.string()), pa.array([k[1] for k in scripts], pa.string()),
                    pa.array([-1] * len(scripts), pa.int64()), pa.array([float(v) for v in scripts.values()], pa.float64()),
                ],
                ["lang", "script", "bucket", "n"],
            )

    counted = picked.select("lang", "text").mapInArrow(run, "lang string, script string, bucket bigint, n double")
    # at most languages * (buckets + scripts) rows, whatever the corpus
    found = counted.groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique().tolist())
    counts = np.full((len(langs), 1 << GRAM_BITS), 0.05)
    place = {x: k for k, x in enumerate(langs)}
    names = sorted({s for _, s in SCRIPTS})
    share_of = np.zeros((len(langs), len(names)))
    for lang, part in found.groupby("lang"):
        is_gram = (part["bucket"] >= 0).to_numpy()
        counts[place[lang], part["bucket"].to_numpy()[is_gram]] += part["n"].to_numpy()[is_gram]
        for s, k in zip(part["script"].to_numpy()[~is_gram], part["n"].to_numpy()[~is_gram]):
            share_of[place[lang], names.index(s)] += k
    logp = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if langs else counts
    total = np.maximum(share_of.sum(axis=1, keepdims=True), 1)
    candidate = share_of / total >= MIN_SHARE
    scripts = {s: ~candidate[:, k] for k, s in enumerate(names) if candidate[:, k].any() and not candidate[:, k].all()}
    return LanguageModel(langs, logp, scripts, penalty)


def _ship(df: DataFrame, model: LanguageModel):
    """The model, broadcast: languages * 2 ** GRAM_BITS numbers."""
    return df.sparkSession.sparkContext.broadcast(pickle.dumps(LanguageModel(model.langs, model.logp, model.scripts, model.penalty)))


def _open(shipped) -> LanguageModel:
    """The worker's copy, with its cache of words."""
    return held(("language", zlib.crc32(shipped.value)), lambda: pickle.loads(shipped.value))


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred``, ``score``, ``spans`` (start, end in code points; lang) per row."""
    shipped = _ship(docs, model)
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        own = _open(shipped)
        for batch in slices(batches, ROWS):
            found = own.label(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], spans),
                ],
                [id_col, "lang_pred", "score", "spans"],
            )

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(releasing(run), f"`{id_col}` {kind}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """Rows whose language is found with a score of at least ``least``, with all their columns.

    Where nothing could be learnt, rows with a letter stay.
    """
    shipped = _ship(docs, model)
    at = docs.columns.index(text_col)

    def run(batches):
        own = _open(shipped)
        for batch in slices(batches, ROWS):
            texts = batch.column(at).to_pylist()
            if own.langs:
                keep = [x[0] != UNKNOWN and x[1] >= least for x in own.label(texts)]
            else:
                keep = [bool(t and _WORDS.search(t)) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)


def held_out(id_col: Column) -> Column:
    """The quarter of ids that learning never sees."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    model = fit_languages(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col, **options)
    found = predict_languages(docs, model, id_col, text_col)
    return found.withColumn("held_out", held_out(F.col(id_col)))


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "spans")
