"""Languages of documents and of the stretches of mixed ones.

Script ranges narrow the candidate languages of each word; each word has a score per candidate, from word and letter-trigram
counts; Viterbi with a switching penalty labels the spans of a text; spans shorter than ``MIN_WORDS`` belong to their neighbours.

The scores are fitted on a bounded sample: of each language at most ``SAMPLE_DOCS`` labelled documents, those with the lowest
hash of their id. Labels may be wrong and texts mixed, so the fit is repeated on the spans that a first fit finds.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANGS = ("en", "de", "fr", "es", "pt", "nl", "it")
NONE = "zxx"
#: At most so many labelled documents of each language, none longer than SAMPLE_CHARS, are used to fit the scores.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 20_000
#: At most so many words and trigrams are kept for each language, the commonest first: the bound on what is sent to tasks.
VOCABULARY, TRIGRAMS = 30_000, 6_000
#: Shortest stretch, in words split at white space; shorter texts are one stretch and never faults.
MIN_WORDS = 12
#: Cost of a change of language, and most that one word can say for or against a language, in nats.
SWITCH, CLIP = 7.0, 3.0
#: A text is language only if at least this part of its words, and this many, are known to some language, or this part of so many in a row.
KNOWN_SHARE, KNOWN_WORDS = 0.15, 4
DENSE_SHARE, DENSE_WORDS = 0.6, 40
_CACHE = 500_000

# Names and codes (ISO 639-1, 639-2/B, 639-2/T, English and own names) under which labels come.
NAMES = {
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano castilian",
    "pt": "pt por portuguese português portugues",
    "nl": "nl nld dut dutch nederlands flemish vlaams",
    "it": "it ita italian italiano",
    NONE: "zxx",
}
# Function words that anchor the scores where labelled documents are few or none.
ANCHORS = {
    "en": "the of and to in is that it was for on with this not are from by which",
    "de": "der die das und ist nicht den von mit für auf dem eine ein sich wird im zu",
    "fr": "le la les des et est une dans pour qui pas sur avec du au ce cette sont",
    "es": "el los las y en que una por con para del se es su más lo como este",
    "pt": "o os as e do da em um uma não para com que se na no dos por",
    "nl": "de het een en van is niet op te dat met voor zijn aan er door naar ook",
    "it": "il lo gli di che e un una per non con della del sono nel questo si da",
}
# Scripts whose letters name one language for our purposes; Latin is told apart by words.
SCRIPTS = (("ru", 0x0400, 0x052F), ("el", 0x0370, 0x03FF), ("he", 0x0590, 0x05FF), ("ar", 0x0600, 0x06FF), ("hi", 0x0900, 0x097F), ("th", 0x0E00, 0x0E7F), ("ja", 0x3040, 0x30FF), ("zh", 0x4E00, 0x9FFF), ("ko", 0xAC00, 0xD7AF))
ALL_LANGS = LANGS + tuple(s[0] for s in SCRIPTS)

_MARKS = re.compile("[­̀-ͯ​-‍⁠﻿]+")
_PIECE = re.compile(r"[^\W_]+")
_KANA, _JA = re.compile("[\u3040-\u30ff]"), [x[0] for x in SCRIPTS].index("ja")
_NAME = re.compile(r"\W*[^\W\d_]+(?:[-'’][^\W_]+)*\W*")


def label_language(c: Column) -> Column:
    """The language that a label names: one of ours, another code as it stands, or null for absent and placeholder labels.

    Regions and letter case don't matter (``pt-BR``, ``EN``, ``nl_BE``); 'mul', 'und', 'unknown', 'n/a', blanks and signs are absent.
    """
    plain = F.lower(F.trim(F.regexp_replace(c, r"[_\-].*$", "")))
    names = F.create_map(*(F.lit(x) for lang, ns in NAMES.items() for n in ns.split() for x in (n, lang)))
    absent = plain.isNull() | ~plain.rlike(r"^\p{L}{2,}$") | plain.isin("und", "mul", "mis", "xx", "xxx", "none", "null", "nan", "na", "unknown", "unk", "other", "auto")
    return F.when(absent, F.lit(None)).otherwise(F.coalesce(F.try_element_at(names, plain), plain))


def pieces(word: str) -> list[str]:
    """The parts of a word by letters and digits, without case and accents."""
    if not word.isascii():
        word = _MARKS.sub("", unicodedata.normalize("NFKD", word))
    return _PIECE.findall(word.casefold())


def _script(word: str) -> int:
    """Index into ALL_LANGS if the word's letters are of a script that names a language, else -1; Chinese characters beside kana are Japanese."""
    for ch in word:
        o = ord(ch)
        if o >= 0x370:
            for i, (lang, lo, hi) in enumerate(SCRIPTS):
                if lo <= o <= hi:
                    return len(LANGS) + (_JA if lang == "zh" and _KANA.search(word) else i)
    return -1


class Model:
    """Scores of words and trigrams over LANGS: log of the language's rate over the mean rate, clipped."""

    def __init__(self, words: dict[str, np.ndarray], grams: dict[str, np.ndarray]) -> None:
        self.words, self.grams = words, grams

    def piece(self, p: str) -> tuple[np.ndarray | None, bool]:
        """Score over LANGS, and whether the word is known."""
        got = self.words.get(p)
        if got is not None:
            return got, len(p) > 1
        if len(p) < 4 or not p.isalpha():
            return None, False
        found = [g for k in range(len(p)) if (g := self.grams.get(f"^{p}$"[k : k + 3])) is not None]
        if len(found) < 3:
            return None, False
        s = np.mean(found, axis=0) * 0.5
        return np.clip(s - s.mean(), -0.5, 0.5), False

    def word(self, w: str) -> tuple[np.ndarray, bool]:
        """Score over ALL_LANGS of a word as it stands between blanks, and whether it is known."""
        out = np.zeros(len(ALL_LANGS), dtype=np.float32)
        out[len(LANGS) :] = -CLIP
        if not w.isascii() and (k := _script(w)) >= 0:
            out[:] = -CLIP
            out[k] = CLIP
            return out, True
        known, any_letters = False, False
        for p in pieces(w):
            any_letters |= p.isalpha()
            s, k = self.piece(p)
            known |= k
            if s is not None:
                out[: len(LANGS)] += s
        if not any_letters:
            out[:] = 0
        return np.clip(out, -CLIP, CLIP), known


def _rates(counts: Sequence[Counter], most: int, smooth: float, least: float) -> dict[str, np.ndarray]:
    kept = {w for c in counts for w, _ in c.most_common(most)}
    totals = np.array([sum(c.values()) for c in counts], dtype=float)
    out = {}
    for w in kept:
        n = np.array([c[w] for c in counts], dtype=float)
        if n.sum() < least:
            continue
        r = np.log((n + smooth) / (totals + smooth * (len(kept) + 1)))
        r -= np.log(np.mean(np.exp(r)))
        out[w] = np.clip(r, -CLIP, CLIP).astype(np.float32)
    return out


def _model(spans: Iterator[tuple[int, list[str]]]) -> Model:
    counts, grams = [Counter() for _ in LANGS], [Counter() for _ in LANGS]
    for lang, ws in spans:
        for w in ws:
            for p in pieces(w):
                if p.isalpha():
                    counts[lang][p] += 1
    for i, lang in enumerate(LANGS):
        for w in ANCHORS[lang].split():
            counts[i]["".join(pieces(w))] += 20
        for p, n in counts[i].items():
            t = f"^{p}$"
            for k in range(len(p)):
                grams[i][t[k : k + 3]] += n
    return Model(_rates(counts, VOCABULARY, 0.5, 3), _rates(grams, TRIGRAMS, 5.0, 20))


def fit(texts: Sequence[tuple[str, str]], rounds: int = 2) -> Model:
    """Fit on (language, text) pairs; each further round counts words by the spans that the round before finds."""
    data = [(LANGS.index(lang), t.split()) for lang, t in texts if t and lang in LANGS]
    model = _model(iter(data))
    for _ in range(rounds):
        found = Labeller(model).stretches([" ".join(ws) for _, ws in data])
        model = _model((LANGS.index(lang), ws[a:b]) for (_, ws), st in zip(data, found) for lang, a, b, _ in st if lang in LANGS)
    return model


def sample(documents: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(language, text) of at most ``docs`` documents for each of LANGS: the lowest hashes of doc_id among those of up to ``chars``.

    A first pass counts labels and the second keeps hashes under a bound at which about three times ``docs`` remain, so that no
    language's documents are sorted in one task.
    """
    labelled = documents.where(F.length("text").between(1, chars)).select("doc_id", "text", label_language(F.col("lang")).alias("l")).where(F.col("l").isin(*LANGS))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    n = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.coalesce(*(F.when(F.col("l") == lang, F.lit(max(1, min(1_000_000, -(-3_000_000 * docs // k))))) for lang, k in n.items()), F.lit(0)) if n else F.lit(0)
    w = Window.partitionBy("l").orderBy("__h", "doc_id", "text")
    few = labelled.withColumn("__h", h).where(F.col("__h") < bound).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= docs)
    return sorted((r["l"], r["text"]) for r in few.select("l", "text").collect())


class Labeller:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.at: dict[str, int] = {}
        self.scores = np.zeros((1024, len(ALL_LANGS)), dtype=np.float32)
        self.known = np.zeros(1024, dtype=bool)
        self.solid = np.zeros(1024, dtype=bool)  # words of a language, and names

    def _index(self, w: str) -> int:
        i = len(self.at)
        if i == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.solid = np.concatenate([self.solid, np.zeros_like(self.solid)])
        self.scores[i], self.known[i] = self.model.word(w)
        self.solid[i] = self.known[i] or (len(w) > 3 and w.strip("\"'([<«„“>")[:1].isupper() and _NAME.fullmatch(w) is not None)
        self.at[w] = i
        return i

    def stretches(self, texts: Sequence[str | None], short: bool = False) -> list[list[tuple[str, int, int, float]]]:
        """For each text its stretches (language, first word, end, confidence), words split at white space.

        A text below MIN_WORDS has none, with ``short`` it is one stretch; a text without words never has any.
        Confidence is the part of the stretch's telling words that favour its language, with one more vote for and one against;
        for a text without language, the part of its words that no language knows.
        """
        if len(self.at) > _CACHE:
            self.at.clear()
        at, index = self.at, self._index
        rows: list[np.ndarray] = []
        for t in texts:
            rows.append(np.array([i if (i := at.get(w)) is not None else index(w) for w in (t or "").split()], dtype=np.int32))
        out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        todo = []
        for k, r in enumerate(rows):
            if len(r) < MIN_WORDS:
                out[k] = [self._short(r)] if short and len(r) else []
                continue
            known = int(self.known[r].sum())
            if known < max(KNOWN_WORDS, KNOWN_SHARE * len(r)) and not self._sentences(r):
                out[k] = [(NONE, 0, len(r), 1 - known / len(r))]
            else:
                todo.append(k)
        todo.sort(key=lambda k: len(rows[k]))
        start = 0
        while start < len(todo):
            first, end = len(rows[todo[start]]), start
            while end < len(todo) and len(rows[todo[end]]) <= first * 1.25 + 16 and (end - start + 1) * len(rows[todo[end]]) <= 2_000_000:
                end += 1
            end = max(end, start + 1)
            part = todo[start:end]
            for k, states in zip(part, self._viterbi([rows[k] for k in part])):
                out[k] = self._spans(rows[k], states)
            start = end
        return out

    def _sentences(self, row: np.ndarray) -> bool:
        """Whether some window of DENSE_WORDS words, of however long a dump, is mostly words of a language."""
        known = np.r_[0, np.cumsum(self.known[row])]
        return len(row) >= DENSE_WORDS and int((known[DENSE_WORDS:] - known[:-DENSE_WORDS]).max()) >= DENSE_SHARE * DENSE_WORDS

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        longest, n = max(map(len, rows)), len(rows)
        table = np.concatenate([self.scores[: len(self.at)], np.zeros((1, len(ALL_LANGS)), np.float32)])
        ids = np.full((longest, n), len(table) - 1, dtype=np.int32)
        for j, r in enumerate(rows):
            ids[: len(r), j] = r
        used = np.arange(len(LANGS))
        if (table[:, len(LANGS) :] > 0).any():
            used = np.arange(len(ALL_LANGS))
        table = np.ascontiguousarray(table[:, used])
        v = table[ids[0]].copy()
        came = np.empty((longest, n), dtype=np.int8)
        stayed = np.empty((longest, n, len(used)), dtype=bool)
        for t in range(1, longest):
            came[t] = v.argmax(axis=1)
            switch = v[np.arange(n), came[t]][:, None] - np.float32(SWITCH)
            stayed[t] = v >= switch
            np.maximum(v, switch, out=v)
            v += table[ids[t]]
        states = np.empty((longest, n), dtype=np.int8)
        states[-1] = v.argmax(axis=1)
        cols = np.arange(n)
        for t in range(longest - 1, 0, -1):
            states[t - 1] = np.where(stayed[t, cols, states[t]], states[t], came[t])
        return [states[: len(r), j] for j, r in enumerate(rows)]

    def _spans(self, row: np.ndarray, states: np.ndarray) -> list[tuple[str, int, int, float]]:
        cuts = np.flatnonzero(np.diff(states)) + 1
        spans = [[int(states[a]), int(a), int(b)] for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(states)])]
        solid = self.solid[row]

        def length(s: list[int]) -> int:
            """Words of a span; two or more words of code or numbers at an end don't count."""
            at = np.flatnonzero(solid[s[1] : s[2]])
            if not len(at):
                return 0
            n = s[2] - s[1]
            lead, trail = int(at[0]), n - 1 - int(at[-1])
            return n - (lead if lead > 1 else 0) - (trail if trail > 1 else 0)

        while len(spans) > 1 and length(short := min(spans, key=length)) < MIN_WORDS:
            k = spans.index(short)
            near = [j for j in (k - 1, k + 1) if 0 <= j < len(spans)]
            j = max(near, key=lambda j: spans[j][2] - spans[j][1])
            spans[j] = [spans[j][0], min(spans[j][1], short[1]), max(spans[j][2], short[2])]
            del spans[k]
            merged = [spans[0]]
            for s in spans[1:]:
                if s[0] == merged[-1][0]:
                    merged[-1][2] = s[2]
                else:
                    merged.append(s)
            spans = merged
        return [(ALL_LANGS[lang], a, b, self._confidence(row[a:b], lang)) for lang, a, b in spans]

    def _telling(self, row: np.ndarray) -> np.ndarray:
        s = self.scores[row]
        return s.max(axis=1) - np.sort(s[:, : len(LANGS)], axis=1)[:, -2] > 0.05

    def _confidence(self, row: np.ndarray, lang: int) -> float:
        telling = self._telling(row)
        votes = int((self.scores[row[telling]].argmax(axis=1) == lang).sum())
        return (votes + 1) / (int(telling.sum()) + 2)

    def _short(self, row: np.ndarray) -> tuple[str, int, int, float]:
        """A text under MIN_WORDS as one stretch; without language if no word is known and under half of them are telling."""
        n, known = len(row), int(self.known[row].sum())
        if not known and 2 * int(self._telling(row).sum()) < n:
            return NONE, 0, n, (n + 1) / (n + 2)
        lang = int(self.scores[row].sum(axis=0).argmax())
        return ALL_LANGS[lang], 0, n, self._confidence(row, lang)


def language_stretches(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, label, seg_no, lang, first_word, n_words, n_segs, confidence): one row for each stretch of every document.

    Null and empty texts give no row, texts under MIN_WORDS words one. ``label`` is the delivered label as label_language() reads
    it. Repeated rows give repeated results. Without ``model``, one is fitted on a bounded sample of ``documents``; should no
    label be usable, the anchors alone decide.
    """
    model = model or fit(sample(documents))
    packed = [(list(table), np.stack(list(table.values())) if table else np.zeros((0, len(LANGS)), np.float32)) for table in (model.words, model.grams)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(Model(*(dict(zip(names, scores)) for names, scores in packed)))
        for b in batches:
            found = labeller.stretches(b["text"].tolist(), short=True)
            n = [len(x) for x in found]
            flat = [(k + 1, len(x), *s) for x in found for k, s in enumerate(x)]
            if not flat:  # blank texts alone
                continue
            cols = list(zip(*flat))
            yield pd.DataFrame(
                {
                    "doc_id": np.repeat(b["doc_id"].to_numpy(), n),
                    "label": np.repeat(b["label"].to_numpy(dtype=object), n),
                    "seg_no": cols[0],
                    "lang": cols[2],
                    "first_word": cols[3],
                    "n_words": np.subtract(cols[4], cols[3]),
                    "n_segs": cols[1],
                    "confidence": cols[5],
                }
            )

    given = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", label_language(F.col("lang")).alias("label"))
    return given.mapInPandas(run, "doc_id bigint, label string, seg_no int, lang string, first_word int, n_words int, n_segs int, confidence double")


def label_faults(stretches: DataFrame) -> DataFrame:
    """Stretches of documents whose label is absent, names another language, or that have more than one stretch; none of texts under MIN_WORDS."""
    return stretches.where(F.col("n_words") >= MIN_WORDS).where((F.col("n_segs") > 1) | ~F.col("label").eqNullSafe(F.col("lang")))


def document_languages(stretches: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, lang, confidence, n_segs): the language of most of a document's words, the first one of equals.

    Confidence is that of the language's stretches by their part of all words. A document without text or words is zxx, in no
    stretch, with confidence 1. Every non-null doc_id comes out once; rows of equal doc_id count as one document.
    """
    per_lang = stretches.groupBy("doc_id", "lang").agg(
        F.sum("n_words").alias("n"), F.min("seg_no").alias("seg"), F.sum(F.col("n_words") * F.col("confidence")).alias("sure"), F.max("n_segs").alias("n_segs")
    )
    most = F.max_by(F.struct("lang", "sure"), F.struct("n", -F.col("seg"), "lang"))
    per_doc = per_lang.groupBy("doc_id").agg(most.alias("m"), F.sum("n").alias("words"), F.max("n_segs").alias("n_segs"))
    ids = documents.where("doc_id IS NOT NULL").select("doc_id").distinct()
    return ids.join(per_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("m.lang", F.lit(NONE)).alias("lang"), F.coalesce(F.col("m.sure") / F.col("words"), F.lit(1.0)).alias("confidence"), F.coalesce("n_segs", F.lit(0)).alias("n_segs")
    )
