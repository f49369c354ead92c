"""Hierarchical language identification.

A text's language family is predicted first; then one-versus-one linear support
vector machines tell the languages of that family apart.  Features are hashed
byte trigrams of the whole text (letters lower-cased, all else folded to one
space), as shares of the text's trigrams, so a decision is a mean of trigram
weights and is computed from the flat byte buffer without a loop over rows.

Training uses no more than PER_LANGUAGE labelled texts of a language (chosen by
a hash of the id; the bound is a parameter), each as a whole: executors count its
trigrams, and only the counts go to the driver.

Edge cases: a text that is null or has no letter is `und`, score 0; with no
labelled rows at all every text is `und`; with one language every text with a
letter is that language, score 1; ties go to the language that sorts first;
null labels are not learned from; lang, source and doc_id aren't features; rows
with a null doc_id are learned from and predicted (held_out: false); columns named
lang_pred or score give way to the result's; more than MOST_LANGUAGES labels are an
error.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm import seqhash as sh
from plumbline.llm.common import SLICE_BYTES, Work, batch, map_batches, table

PER_LANGUAGE = 1500
BUCKETS = 1 << 15
EPOCHS, REGULARISATION = 12, 1e-4
UNKNOWN = "und"
#: Machines grow with the square of the languages.
MOST_LANGUAGES = 500

#: Families of common languages; a language that isn't listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
    "indic": ("hi", "bn", "mr", "ur", "ta", "te"),
    "sinitic": ("zh", "yue"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

#: Bytes as features see them: letters lower-cased, UTF-8 bytes as they are.
FOLD = np.full(256, 0x20, dtype=np.uint8)
FOLD[ord("a") : ord("z") + 1] = FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[0x80:] = np.arange(0x80, 256)


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode's category L (which isalpha() tests)."""
    return any(map(str.isalpha, text))


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each byte but the last two."""
    f = FOLD[data].astype(np.uint32)
    code = (f[:-2] << np.uint32(16)) | (f[1:-1] << np.uint32(8)) | f[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int32)


class Model:
    """Weights of all machines side by side: a score of a text is the mean of
    its trigrams' rows."""

    def __init__(self, languages: list[str]) -> None:
        self.languages = sorted(languages)
        groups: dict[str, list[str]] = {}
        for lang in self.languages:
            groups.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
        self.groups = groups
        self.machines: list[tuple[tuple[str, ...], tuple[str, ...]]] = [(tuple(groups[a]), tuple(groups[b])) for a, b in itertools.combinations(sorted(groups), 2)]
        self.machines += [((a,), (b,)) for g in sorted(groups) for a, b in itertools.combinations(groups[g], 2)]
        self.weights = np.zeros((BUCKETS, max(1, len(self.machines))), dtype=np.float32)
        self.bias = np.zeros(max(1, len(self.machines)), dtype=np.float32)

    def fit(self, langs: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]]) -> Model:
        """rows: (buckets, shares) of each text."""
        for k, (left, right) in enumerate(self.machines):
            y = np.where(np.isin(langs, left), 1.0, np.where(np.isin(langs, right), -1.0, 0.0))
            use = np.flatnonzero(y)
            w, b = linear_svm([rows[i] for i in use], y[use], seed=k)
            self.weights[:, k], self.bias[k] = w, b
        return self

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Margins (rows x machines) of texts that lie side by side."""
        n = len(offsets) - 1
        out = np.tile(self.bias, (n, 1))
        if len(data) < 3:
            return out
        code = trigrams(data)
        starts, stops = offsets[:-1], np.maximum(offsets[1:] - 2, offsets[:-1])
        has = np.flatnonzero(stops > starts)
        if not len(has):
            return out
        # reduceat() sums from one start to the next: the two trigrams that
        # reach into the next text are in between, and go to sums of their own.
        cuts = np.stack([starts[has], stops[has]], axis=1).ravel()
        cuts = np.minimum(cuts, len(code))
        padded = np.append(code, 0)
        for k in range(self.weights.shape[1]):
            column = np.ascontiguousarray(self.weights[:, k])
            gathered = column[padded]
            gathered[-1] = 0
            sums = np.add.reduceat(gathered, cuts, dtype=np.float64)[::2]
            out[has, k] += (sums / (stops[has] - starts[has])).astype(np.float32)
        return out

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language index and score (0 to 1) of each row of margins."""
        n, langs = len(margins), self.languages
        names = sorted(self.groups)
        sure = 1.0 / (1.0 + np.exp(-np.clip(4.0 * np.abs(margins.astype(np.float64)), 0, 50)))

        def vote(members: list, sides) -> tuple[np.ndarray, np.ndarray]:
            votes, total, least = (np.zeros((n, len(members))) for _ in range(3))
            least += 1.0
            for k, (a, b) in sides:
                i, j = members.index(a), members.index(b)
                won = margins[:, k] >= 0
                votes[:, i] += won
                votes[:, j] += ~won
                total[:, i] += margins[:, k]
                total[:, j] -= margins[:, k]
                least[:, i] = np.where(won, np.minimum(least[:, i], sure[:, k]), least[:, i])
                least[:, j] = np.where(won, least[:, j], np.minimum(least[:, j], sure[:, k]))
            best = np.argmax(votes * 1e6 + total, axis=1) if members else np.zeros(n, dtype=int)
            return best, least[np.arange(n), best]

        family_of = {self.groups[g][0]: g for g in names}
        sides = [(k, (family_of[a[0]], family_of[b[0]])) for k, (a, b) in enumerate(self.machines) if FAMILY_OF.get(a[0], a[0]) != FAMILY_OF.get(b[0], b[0])]
        family, score = vote(names, sides)
        index = np.zeros(n, dtype=np.int64)
        for f, g in enumerate(names):
            mine = family == f
            members = self.groups[g]
            sides = [(k, (a[0], b[0])) for k, (a, b) in enumerate(self.machines) if a[0] in members and b[0] in members and len(a) == len(b) == 1 and FAMILY_OF.get(a[0], a[0]) == FAMILY_OF.get(b[0], b[0])]
            best, s = vote(members, sides)
            index[mine] = np.array([langs.index(x) for x in members])[best[mine]]
            score[mine] = np.minimum(score[mine], s[mine])
        return index, score


def linear_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM by dual coordinate descent over sparse rows, each
    scaled to length one for training; classes weigh the same."""
    rng = np.random.default_rng(seed)
    n = len(y)
    norms = np.array([max(np.sqrt((v * v).sum()), 1e-12) for _, v in rows])
    share = {s: max(1, int((y == s).sum())) for s in (1.0, -1.0)}
    cap = np.array([n / (2 * share[s]) for s in y]) / (REGULARISATION * n)
    w, b = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(n)
    for _ in range(EPOCHS):
        for i in rng.permutation(n):
            at, v = rows[i]
            x = v / norms[i]
            g = y[i] * (w[at] @ x + 0.1 * b) - 1
            new = min(max(alpha[i] - g / 1.01, 0.0), cap[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * x
                b += step * 0.1
                alpha[i] = new
    # Scoring uses shares, not unit length: bring the weights to that scale.
    scale = 1.0 / np.median(norms) if n else 1.0
    return w * scale, 0.1 * b


def counted(docs: DataFrame) -> DataFrame:
    """All columns but text, at (buckets, as 16-bit numbers) and n (counts, as 64-bit numbers) of the
    trigrams of each whole text."""

    types = dict(docs.dtypes)
    kept = [c for c in docs.columns if c != "text"]

    def run(b: pa.RecordBatch):
        data, offsets = sh.text_buffer(b.column("text"))
        at, n = [], []
        for lo, hi in zip(offsets[:-1], offsets[1:]):
            total = np.zeros(BUCKETS, dtype=np.int64)
            # The text and two blanks; pieces overlap by two bytes.
            for start in range(lo, hi, SLICE_BYTES):
                stop = min(start + SLICE_BYTES, hi)
                more = data[stop : min(stop + 2, hi)]
                piece = np.concatenate([data[start:stop], more, np.full(2 - len(more), 0x20, dtype=np.uint8)])
                total += np.bincount(trigrams(piece), minlength=BUCKETS)
            found = np.flatnonzero(total)
            at.append(found.astype(np.uint16).tobytes())
            n.append(total[found].tobytes())
        yield batch(**{c: b.column(c) for c in kept}, at=pa.array(at, pa.binary()), n=pa.array(n, pa.binary()))

    return map_batches(docs, run, "".join(f"`{c}` {types[c]}, " for c in kept) + "at binary, n binary")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """docs: doc_id, text, lang; a bounded sample of them by a hash of the id."""
    labelled = docs.where("lang is not null and text is not null").select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("pick"))
    # A row for each language; more than MOST_LANGUAGES of them is an error.
    counts = [(r.lang, r["count"]) for r in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()]
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the column lang doesn't hold languages")
    languages = sorted(lang for lang, _ in counts)
    model = Model(languages)
    if not languages:
        return model
    # The rows below a bound on their hash: somewhat more than needed in all, so no
    # task sends more than its share of them.  One pass serves all languages.
    shares = [(lang, int(min(1.0, (1.2 * per_language + 100) / n) * (1 << 40))) for lang, n in counts]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, most long")
    picked = labelled.join(F.broadcast(shares), "lang").where("pick < most")
    order = Window.partitionBy("lang").orderBy("pick", F.xxhash64("text"))
    picked = picked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
    sample = [(r.lang, r.at, r.n) for r in sorted(counted(picked.select("lang", "pick", "text")).collect(), key=lambda r: (r.lang, r.pick, r.at, r.n))]
    if len(languages) < 2:
        return model
    rows = []
    for _, at, n in sample:
        n = np.frombuffer(n, dtype=np.int64)
        rows.append((np.frombuffer(at, dtype=np.uint16), n / max(1, n.sum())))
    return model.fit(np.array([lang for lang, *_ in sample]), rows)


def predict(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and further columns of every row (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = [c for c in docs.columns if c not in ("doc_id", "lang_pred", "score") and (keep_text or c != "text")]
    types = dict(docs.dtypes)

    def run(b: pa.RecordBatch):
        m = shared.value
        texts = b.column("text")
        data, offsets = sh.text_buffer(texts)
        for lo, hi in sh.row_slices(offsets, SLICE_BYTES):
            d, o = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            index, score = m.decide(m.margins(d, o)) if m.languages else (np.zeros(hi - lo, dtype=int), np.zeros(hi - lo))
            # Almost all texts have an ASCII letter; only the rest is looked at.
            fold = FOLD[d]
            letters = np.concatenate([[0], np.cumsum((fold >= ord("a")) & (fold <= ord("z")))])
            known = letters[o[1:]] > letters[o[:-1]]
            for i in np.flatnonzero(~known):
                known[i] = has_letter(texts[lo + i].as_py() or "")
            known &= bool(m.languages)
            names = [m.languages[k] if ok else UNKNOWN for k, ok in zip(index, known)]
            yield batch(doc_id=b.column("doc_id").slice(lo, hi - lo), **{c: b.column(c).slice(lo, hi - lo) for c in extra}, lang_pred=names, score=np.where(known, score, 0.0))

    schema = ", ".join(["doc_id long", *(f"`{c}` {types[c]}" for c in extra), "lang_pred string", "score double"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(c for c in extra if c != "text")), run, schema)


def held_out():
    """Whether a row is never learned from: crc32 of its id, as text, mod 3 is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    work = Work(spark, "language", docs)
    model = train(docs.where(~held_out()))
    out = predict(docs.select("doc_id", "text"), model)
    return work.few(out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
