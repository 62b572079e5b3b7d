"""Language identification by interpolated Kneser-Ney models of characters, one per language.

All models are columns of shared tables: sorted arrays of packed character n-grams, with a value per language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import by_slices, documents
from millrace.operators.sizing import spread

#: Characters per n-gram, bits per character, and so the different letters that are told apart: all that any script in use has.
ORDER = 4
BITS = 16
LETTERS = (1 << BITS) - 2
OTHER = (1 << BITS) - 1
#: The models are fitted on at most about this many labelled documents of each language, the smallest by hash. One in
#: FOURTH of them is kept out of the counts, for calibration.
PER_LANGUAGE = 3000
FOURTH = 4
#: A document is rejected beyond this quantile of the cross-entropies of calibration documents, with a margin.
QUANTILE, MARGIN = 0.999, 1.25
UNKNOWN = "und"
#: Characters of a text that are scored at a time.
PIECE = 1 << 19


def alphabet_of(letters: dict[str, int]) -> np.ndarray:
    """Code by code point: 0 for what is no letter, 1.. for known letters, OTHER for all other letters."""
    code = np.array([OTHER if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint16)
    for i, x in enumerate(sorted(letters, key=lambda x: (-letters[x], x))[:LETTERS]):
        code[ord(x)] = i + 1
    return code


def symbols(texts: list[str | None], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first): the lower-cased texts as codes, runs of other characters as one 0, and where each
    text begins. Every text ends in a 0."""
    lower = [(x or "").lower() + "\n" for x in texts]
    s = code[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)]
    first = np.cumsum([0, *map(len, lower)])
    begins = np.zeros(len(s) + 1, bool)
    begins[first] = True
    keep = (s != 0) | np.concatenate([[True], s[:-1] != 0]) | begins[:-1]
    return s[keep].astype(np.uint64), np.concatenate([[0], np.cumsum(keep)])[first]


def grams(s: np.ndarray, first: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol; before a text there are zeros."""
    out = s.copy()
    for back in range(1, order):
        before = np.concatenate([np.zeros(back, np.uint64), s[:-back]])[:len(s)]
        for j in range(back):
            at = first[:-1] + j
            before[at[at < first[1:]]] = 0
        out |= before << np.uint64(BITS * back)
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of each wanted key in a sorted array."""
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    #: By order: sorted n-grams and their discounted shares, sorted contexts and what is handed down.
    keys: list[np.ndarray]
    share: list[np.ndarray]
    contexts: list[np.ndarray]
    down: list[np.ndarray]
    #: Log probabilities of all n-grams of the highest order that any language has.
    log: np.ndarray
    limit: np.ndarray
    scale: float

    @classmethod
    def fit(cls, languages: list[str], code: np.ndarray, lang: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Model:
        """From counts of n-grams of the highest order, by language."""
        keys, share, contexts, down = [], [], [], []
        size = len(languages)
        triples = (lang, gram, count)
        for order in range(ORDER, 0, -1):
            l, g, c = triples
            own = np.unique(g)
            at = np.searchsorted(own, g)
            table = np.zeros((len(own), size))
            table[at, l] = c
            ones, twos = (table == 1).sum(axis=0), (table == 2).sum(axis=0)
            discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5).clip(0.05, 0.95)
            heads, where = np.unique(own >> np.uint64(BITS), return_inverse=True)
            total, kinds = np.zeros((len(heads), size)), np.zeros((len(heads), size))
            np.add.at(total, where, table)
            np.add.at(kinds, where, table > 0)
            keys.append(own)
            contexts.append(heads)
            share.append(np.maximum(table - discount, 0) / np.maximum(total, 1)[where])
            down.append(np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0))
            # the next lower order counts in how many different contexts a gram goes on from
            if order > 1:
                top = np.uint64(BITS * (order - 1))
                low = g & np.uint64((1 << BITS * (order - 1)) - 1)
                both, c = np.unique(l.astype(np.uint64) << top | low, return_counts=True)
                triples = (both >> top).astype(np.int64), both & np.uint64((1 << BITS * (order - 1)) - 1), c
        for x in (keys, share, contexts, down):
            x.reverse()
        model = cls(languages, code, keys, share, contexts, down, np.zeros((0, size)), np.full(size, np.inf), 1.0)
        model.log = np.log(model.probability(keys[-1])).astype(np.float32) if len(keys[-1]) else model.log
        return model

    def probability(self, gram: np.ndarray) -> np.ndarray:
        p = np.full((len(gram), len(self.languages)), 1.0 / (1 << BITS))
        for order in range(1, ORDER + 1):
            if not len(self.keys[order - 1]):  # nothing was counted
                continue
            low = gram & np.uint64((1 << BITS * order) - 1)
            at, there = _find(self.contexts[order - 1], low >> np.uint64(BITS))
            p = np.where(there[:, None], self.down[order - 1][at] * p, p)
            at, there = _find(self.keys[order - 1], low)
            p += np.where(there[:, None], self.share[order - 1][at], 0)
        return p

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probability of each text in each language, its number of symbols, and of letters."""
        s, first = symbols(texts, self.code)
        gram = grams(s, first)
        at, there = _find(self.keys[-1], gram)
        log = self.log[at] if len(self.log) else np.zeros((len(gram), len(self.languages)))
        log[~there] = np.log(self.probability(gram[~there]))
        letters = np.concatenate([[0], np.cumsum(s != 0)])
        sums = np.concatenate([np.zeros((1, log.shape[1])), np.cumsum(log, axis=0, dtype=np.float64)])
        return sums[first[1:]] - sums[first[:-1]], np.diff(first), letters[first[1:]] - letters[first[:-1]]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """(language, score, cross-entropy in nats per symbol, rejected) of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, None, True)] * len(texts)
        # very long texts in pieces, which are scored one by one and added up
        pieces = [[x[i:i + PIECE] for i in range(0, len(x), PIECE)] if x and len(x) > PIECE else [x] for x in texts]
        if len(pieces) == 1:
            total, n, letters = (np.sum(x, axis=0) for x in zip(*(self.totals([p]) for p in pieces[0])))
        else:
            total, n, letters = self.totals([p for x in pieces for p in x])
            first = np.cumsum([0, *[len(x) for x in pieces[:-1]]])
            total, n, letters = (np.add.reduceat(x, first, axis=0) for x in (total, n, letters)) if len(first) else (total, n, letters)
        out = []
        for t, size, some in zip(total, n, letters):
            if not some:
                out.append((UNKNOWN, 0.0, None, True))
                continue
            best = int(np.argmax(t))
            score = 1 / np.exp((t - t[best]) * self.scale).sum()
            entropy = float(-t[best] / size)
            out.append((self.languages[best], float(score), entropy, entropy > self.limit[best]))
        return out

    def calibrate(self, texts: list[str], lang: list[int]) -> None:
        """The scale at which scores fit best as probabilities, and each language's highest usual cross-entropy."""
        parts = [self.totals(texts[i:i + 32]) for i in range(0, len(texts), 32)] or [self.totals([])]
        total, n, letters = (np.concatenate(x) for x in zip(*parts))
        lang, some = np.array(lang, np.int64), letters > 0
        total, n, lang = total[some], n[some], lang[some]

        def loss(scale):
            z = (total - total.max(axis=1, keepdims=True)) * scale
            return -(z[np.arange(len(lang)), lang] - np.log(np.exp(z).sum(axis=1))).mean()
        if len(lang):
            self.scale = min((2.0 ** -e for e in range(12)), key=loss)
        for i in range(len(self.languages)):
            mine = -total[lang == i, i] / n[lang == i]
            if len(mine):
                self.limit[i] = np.quantile(mine, QUANTILE) * MARGIN


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from all learning; rows without a doc_id are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """A model of the labelled documents that are not held out. Its size is bounded by the sample's."""
    labelled = documents(docs, F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy(F.col("lang").cast("string").alias("lang")).count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model.fit([], np.zeros(0x110000, np.uint16), *(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64)))
    # by id and text: rows that share an id, or have none, are drawn one by one all the same
    draw = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(1 << 30))
    share = F.create_map(*[x for l, c in counts.items() for x in (F.lit(l), F.lit(int(min(1.0, PER_LANGUAGE / c) * (1 << 30))))])
    # of a language with hardly any documents all are counted
    enough = F.create_map(*[x for l, c in counts.items() for x in (F.lit(l), F.lit(c >= 2 * FOURTH))])
    sample = labelled.where(draw < F.element_at(share, F.col("lang"))).withColumn(
        "apart", F.element_at(enough, F.col("lang")) & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(FOURTH)) == 0))
    letters = (sample.select(F.explode(F.split(F.lower("text"), "")).alias("x")).groupBy("x").count()
               .where(F.length("x") == 1).orderBy(F.desc("count"), "x").limit(2 * LETTERS).collect())
    code = alphabet_of({r.x: r["count"] for r in letters if r.x.isalpha()})
    number = {l: i for i, l in enumerate(languages)}

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = ([], [], [])
        lang = batch.column(1).to_pylist()
        for l in set(lang):
            s, first = symbols([x for x, y in zip(batch.column(0).to_pylist(), lang) if y == l], code)
            g, c = np.unique(grams(s, first), return_counts=True)
            for out, x in zip(rows, (np.full(len(g), number[l]), g.view(np.int64), c)):
                out.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in rows], ["lang", "gram", "n"])

    table = (sample.where(~F.col("apart")).select("text", "lang").mapInArrow(by_slices(count, 512, 0), "lang long, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
    model = Model.fit(languages, code, lang, gram.view(np.uint64), n)
    apart = sample.where("apart").select("text", "lang").toArrow()
    model.calibrate(apart.column("text").to_pylist(), [number[l] for l in apart.column("lang").to_pylist()])
    return model


def identify(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (default doc_id), held_out, lang_pred, score (0 to 1), cross_entropy (nats per symbol)
    and rejected.

    The language is the one whose model has the lowest cross-entropy per symbol over the whole text; the score is
    its share among all languages, scaled to fit calibration documents. Null texts and texts without a letter
    are ``und`` with score 0 and count as rejected, as do texts further from their language than practically all
    calibration documents. Rows without a label, or held out, teach nothing; with no labelled row at all
    every document is ``und``. Every row gives one row. An empty table gives an empty result. Columns that are not
    carried play no part, whatever their names.
    """
    carry = carry or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    others = [c for c in carry if c != "text"]
    source = spread(docs).select((F.struct(*others) if others else F.lit(0)).alias("row"), held_out(F.col("doc_id")).alias("held_out"),
                                 F.col("text").cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        answers = shared.value.predict(batch.column(2).to_pylist())
        columns = [pa.array(list(c), t) for c, t in zip(zip(*answers), (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score", "cross_entropy", "rejected"])
    row = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(by_slices(work, 256, 2), f"row {row}, held_out boolean, text string, lang_pred string, score double, "
                                                 "cross_entropy double, rejected boolean")
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in carry],
                      "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def in_a_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, in their columns."""
    named = identify(docs, [*docs.columns, *[c for c in ("doc_id", "text") if c not in docs.columns]])
    at = named.columns.index("held_out")
    # by place, as a column of docs may be called like one of the answers
    return named.toDF(*[f"c{i}" for i in range(len(named.columns))]).where(f"not c{at + 4}").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
