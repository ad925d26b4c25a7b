"""Template residue and error-page text: likelihood-ratio windows of character n-gram models.

Models of character n-grams are fitted for unfilled marks, filler, notices (error pages, scripts needed), natural prose,
and text that only speaks of such things. Along a text, the log likelihood ratio of each kind against prose is summed
in windows; where a window exceeds the kind's threshold, a passage begins, which grows as long as windows stay above
it. A passage stands if its whole ratio suffices and no window around it is better explained by the model of speech
about residue, whose n-grams count only where no kind of residue explains them. What stands is measured: a record is excluded
by how much of it the passages of a kind cover. Prose is counted on all records: once on all, then on those without passages.

Texts are coded one byte a character in upper bounds of a batch, so a batch is one array and every step is a pass of
vector arithmetic: the cost is a few dozen instructions a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm import residue_samples as S
from refloom.sources.tables import table

N, BITS = 4, 18
#: Characters in a window and the mean log likelihood ratio in it from which it is residue, by kind.
WINDOWS = {"mark": (8, 1.3), "filler": (20, 1.2), "notice": (24, 1.2)}
#: The whole log likelihood ratio that a passage needs.
EVIDENCE = 9.0
#: Characters in a window of speech about residue, and the mean ratio from which it is that.
SPOKEN = (40, 0.6)
#: A record is excluded if passages of a kind cover more than this share of it; a mark is residue wherever it stands.
COVERAGE = {"mark": 0.0, "filler": 0.001, "notice": 0.001}
#: Bounds of `prose_sample`, which no query uses.
PROSE_ROWS, PROSE_CHARS = 2_000, 20_000
_LOWER = bytes(ord(chr(b).lower()) if len(chr(b).lower()) == 1 and ord(chr(b).lower()) < 256 else b for b in range(256)).translate(bytes(48 if 48 <= b <= 57 else 32 if b in (9, 10, 13, 160) else b for b in range(256)))


#: Characters whose arrays are held at once.
PIECE = 1_000_000
#: The code that parts texts, longer than any window.
GAP, _AROUND = 1, np.full(64, 1, dtype=np.uint8)


def coded(text: str) -> np.ndarray:
    """One byte a character: lower case, digits alike, what Latin-1 lacks as '?'. Offsets are those of the text."""
    return np.frombuffer(text.encode("latin-1", "replace").translate(_LOWER), dtype=np.uint8)


def grams(code: np.ndarray) -> np.ndarray:
    """The hash of the n-gram that ends at each character from the n-th on."""
    x = code.astype(np.uint32)
    h = x[: len(x) - N + 1].copy()
    for k in range(1, N):
        h *= np.uint32(0x01000193)
        h ^= x[k : len(x) - N + 1 + k]
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BITS)


def counts(texts: list[str]) -> np.ndarray:
    joined = coded("\n\n\n\n".join(texts))
    return np.bincount(grams(joined), minlength=1 << BITS).astype(np.float64) if len(joined) >= N else np.zeros(1 << BITS)


def tally(texts: list[str]) -> np.ndarray:
    """How often each n-gram occurs in texts, each of them between blanks, so that sums over any batches are alike."""
    blank = "\n" * N
    if not texts:
        return np.zeros(1 << BITS, dtype=np.int64)
    return np.bincount(grams(coded(blank + blank.join(texts) + blank[1:])), minlength=1 << BITS)


def _ratios(natural: np.ndarray) -> dict[str, np.ndarray]:
    pn = (natural + 0.5) / (natural.sum() + 0.5 * (1 << BITS))
    kinds = {"mark": S.marks(), "filler": S.fillers(), "notice": [t + end for t in (*S.ERRORS, *S.SCRIPTS) for end in ("", "!")], "spoken": list(S.SPOKEN)}
    out = {}
    for kind, texts in kinds.items():
        c = counts(texts)
        ratio = np.where(c > 0, np.log(np.maximum(c, 0.1) / c.sum()) - np.log(pn), -1.5)
        ratio[grams(coded(" " * N))] = -1.5  # blanks only part the samples
        out[kind] = np.clip(ratio, -2.5, 4.0).astype(np.float32)
    known = np.maximum.reduce([out[kind] for kind in WINDOWS]) > 0
    out["spoken"] = np.where(known, np.minimum(out["spoken"], 0), out["spoken"])
    return out


def fit(prose: list[str]) -> dict[str, np.ndarray]:
    """The log likelihood ratio of every n-gram against prose, for each kind and for speech about residue.

    `prose` may itself hold residue: what the first models find in it is left out of the second and last fit.
    """
    first = _ratios(counts(prose))
    clean = [t for t in prose if not any(passages(coded(t), first).values())]
    return _ratios(counts(clean))


def passages(code: np.ndarray, model: dict[str, np.ndarray]) -> dict[str, list[tuple[int, int]]]:
    """For each kind the half-open spans of characters that are residue."""
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in WINDOWS}
    code = np.concatenate([_AROUND, code, _AROUND])
    g = grams(code)
    # n-grams that reach into a gap say nothing, so a short text is judged alike alone and among others
    gap = np.concatenate([[0], np.cumsum(code == GAP)])
    inside = (gap[N:] == gap[:-N]).astype(np.float64)
    speech = None
    for kind, (w, least) in WINDOWS.items():
        total = np.concatenate([[0.0], np.cumsum(model[kind][g] * inside)])
        high = np.flatnonzero(total[w:] - total[:-w] > least * w)
        if not len(high):
            continue
        if speech is None:
            sw = SPOKEN[0]
            run = np.concatenate([[0.0], np.cumsum(model["spoken"][g] * inside)])
            speech = np.concatenate([[0], np.cumsum(run[sw:] - run[:-sw] > SPOKEN[1] * sw)])
        breaks = np.flatnonzero(np.diff(high) > w)
        starts, ends = high[np.r_[0, breaks + 1]], high[np.r_[breaks, len(high) - 1]] + w
        # windows of speech that begin near the passage's beginning or within it
        lo, hi = np.clip(starts - sw - 5, 0, len(speech) - 1), np.clip(ends + 5, 0, len(speech) - 1)
        lo = np.minimum(lo, np.maximum(hi - 1, 0))
        stands = (total[ends] - total[starts] > EVIDENCE) & (speech[hi] == speech[lo])
        shift, last = len(_AROUND), len(code) - 2 * len(_AROUND)
        out[kind] = [(max(int(a) - shift, 0), min(int(b) + N - 1 - shift, last)) for a, b in zip(starts[stands], ends[stands], strict=True)]
    return out


def pieces(ids: Iterable, texts: Iterable[str]) -> Iterator[tuple[list, list[str]]]:
    """The rows of a batch in runs of at most PIECE characters, which bounds the arrays; a longer text is a run of its own."""
    some, run, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        if run and size + len(t) > PIECE:
            yield some, run
            some, run, size = [], [], 0
        some.append(i)
        run.append(t)
        size += len(t)
    if run:
        yield some, run


def judge(texts: list[str], model: dict[str, np.ndarray]) -> dict[tuple[int, str], set[tuple[int, int]]]:
    """The passages by a text's place in the list and kind."""
    gap = chr(GAP) * len(_AROUND)
    code = coded(gap.join(texts))
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + len(gap))[:-1]])
    rows: dict[tuple[int, str], set[tuple[int, int]]] = {}
    for kind, spans in passages(code, model).items():
        for a, b in spans:
            i = int(np.searchsorted(starts, a, side="right")) - 1
            j = int(np.searchsorted(starts, b - 1, side="right")) - 1
            for k in range(i, j + 1):
                x, y = max(a - int(starts[k]), 0), min(b - int(starts[k]), int(lengths[k]))
                if x < y:
                    rows.setdefault((k, kind), set()).add((x, y))
    return rows


def tallied(records: DataFrame, text: str, model: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """`tally` of all texts, with a model of those in which it finds nothing; the driver gets 2 ** BITS rows at most."""
    shared = records.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << BITS, dtype=np.int64)
        for pdf in parts:
            for _, texts in pieces(pdf["_text"], pdf["_text"]):
                if shared.value is not None:
                    bad = {k for k, _ in judge(texts, shared.value)}
                    texts = [t for k, t in enumerate(texts) if k not in bad]
                total += tally(texts)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"gram": seen.astype(np.int32), "n": total[seen]})

    rows = records.select(F.col(text).alias("_text")).where("_text <> ''").mapInPandas(run, "gram int, n long")
    got = rows.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS)
    out[got["gram"].to_numpy()] = got["n"].to_numpy()
    return out


def fit_records(records: DataFrame, text: str) -> dict[str, np.ndarray]:
    """`fit` on every text of `records`, of any length; a repeated row counts again."""
    return _ratios(tallied(records, text, _ratios(tallied(records, text))))


def detect(records: DataFrame, doc_id: str, text: str, prose: list[str] | None = None) -> DataFrame:
    """(doc_id, kind, passages, covered, coverage) of the records with residue, a row for each kind found.

    covered are the characters of the passages, coverage their share. Whole texts are read, of any length; a
    null or empty text has no residue; repeated rows of a record give one row. Texts that are alike are judged alike.
    The models are fitted on `prose`, without it on all of `records`.
    """
    cols = records.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).where("doc_id is not null and _text <> ''")
    shared = records.sparkSession.sparkContext.broadcast(fit_records(cols, "_text") if prose is None else fit(prose))
    key = cols.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out: list[tuple] = []
            for ids, texts in pieces(pdf["doc_id"], pdf["_text"]):
                for (k, kind), spans in judge(texts, shared.value).items():
                    covered = sum(y - x for x, y in spans)
                    out.append((ids[k], kind, len(spans), covered, covered / max(1, len(texts[k]))))
            yield pd.DataFrame(out, columns=["doc_id", "kind", "passages", "covered", "coverage"])

    found = cols.mapInPandas(run, f"doc_id {key}, kind string, passages int, covered long, coverage double")
    return found.groupBy("doc_id", "kind").agg(F.max("passages").alias("passages"), F.max("covered").alias("covered"), F.max("coverage").alias("coverage"))


def excluded(found: DataFrame, least: dict[str, float] | None = None) -> DataFrame:
    """(doc_id) of the records that `detect` found to hold more residue of a kind than its share in `least` (COVERAGE)."""
    bar = F.lit(0.0)
    for kind, share in (COVERAGE if least is None else least).items():
        bar = F.when(F.col("kind") == kind, F.lit(share)).otherwise(bar)
    return found.where(F.col("coverage") > bar).select("doc_id").distinct()


def prose_sample(records: DataFrame, doc_id: str, text: str, rows: int = PROSE_ROWS, chars: int = PROSE_CHARS) -> list[str]:
    """A bounded sample of prose, at most rows x chars characters, to try models on; the queries count all records.

    Rows are drawn by a hash of their id with the share that gives about `rows` of them, so what all tasks together
    send is bounded, however many there are.
    """
    few = records.select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
    n = few.count()
    drawn = F.pmod(F.xxhash64("i", F.lit(10)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, rows / max(1, n))))
    got = few.where(drawn & F.length("t").between(200, chars)).collect()
    return [r["t"] for r in sorted(got)][:rows]


def _found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    return detect(docs, "doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return excluded(_found(spark, d))


def p10_passages(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of residue in each record, with coverage."""
    return _found(spark, d).withColumn("coverage", F.round("coverage", 6))


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    """The ids of the records that remain."""
    found = excluded(_found(spark, d))
    return table(spark, d, "documents", "doc_id").distinct().join(found, "doc_id", "left_anti")


def queries() -> dict:
    return {"p10_found": p10_found, "p10_passages": p10_passages, "p10_kept": p10_kept}


def oracle_sql() -> dict[str, str]:
    return {}
