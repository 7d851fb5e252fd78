"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities, ``BUCKETS`` rows by one column a
language, fitted on a bounded sample of the labelled rows (``SAMPLE`` documents
a language; every label is learned) and broadcast: 2^16 x 4 bytes a language.
It is held, fitted and summed in blocks of ``COLUMNS`` languages. Scoring sums
the rows of a text's n-grams in numpy, slice by slice, over the whole text.

N-grams are of 1 to 3 characters over the lower-cased text in which every run
of characters that are not letters counts as one space.

The posterior compares the learned languages with one another and is near 1 for
texts of none of them, too. How far a text is from the predicted language itself
is its ``surprise``: by how many nats the mean log probability of its n-grams
falls below the mean over the language's own n-grams, less ``SPREAD`` standard
errors of a text of that many n-grams. Both moments come from the matrix.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is everything when no labelled row exists to learn from; its ``surprise`` is null. A null ``doc_id`` is
not held out and not learned from. Repeated rows get equal results; equal
scores go to the language first in order. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, ship

BUCKETS = 1 << 16
ORDERS = 3
SAMPLE = 3000
COLUMNS = 64           # languages in one block of the matrix
FOLDS = 5
SMOOTH = 0.5
SLICE = 1 << 18        # characters scored at once
UNKNOWN = "und"
SPREAD = 3.0

_LETTERS: list = []


def _letters():
    """For each code point, whether it is a letter; built once for each worker process."""
    if not _LETTERS:
        import sys

        import numpy as np

        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def grams(texts: list[str]):
    """Yields ``(rows, buckets)`` of numpy arrays: the text's number and the bucket of every n-gram, in slices."""
    import numpy as np

    letters, k, at = _letters(), 0, 0
    while k < len(texts):
        parts, rows, room = [], [], SLICE
        while k < len(texts) and room > 0:
            # a long text goes on in the next slice, two characters earlier
            piece = texts[k][at:at + room]
            codes = np.frombuffer((piece.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
            parts.append(codes)
            rows.append(np.full(len(codes), k, np.int64))
            room -= len(piece) + 1
            if at + len(piece) < len(texts[k]):
                at += max(1, len(piece) - 2)
            else:
                k, at = k + 1, 0
        code, row = np.concatenate(parts), np.concatenate(rows)
        ok = letters[code]
        code = np.where(ok, code, 32).astype(np.uint64)
        new = np.empty(len(row), bool)
        new[:1], new[1:] = True, row[1:] != row[:-1]
        keep = ok | new
        keep[1:] |= ok[:-1]          # of a run without letters only the first
        code, row = code[keep], row[keep]
        for n in range(1, ORDERS + 1):
            if len(code) < n:
                break
            m = len(code) - n + 1
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = (h ^ code[i:i + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            same = row[:m] == row[n - 1:]
            if n == 1:
                same &= code != 32
            yield row[:m][same], (h >> np.uint64(40)).astype(np.int64)[same] % BUCKETS


def _fold(docs: DataFrame):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def _counts(labels: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def said():
            cols = [(np.full(len(y), i, np.int32), y.astype(np.int32), n[y]) for i, n in total.items() for y in [np.flatnonzero(n)]]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([c[k] for c in cols])) for k in range(3)],
                                              ["label", "bucket", "n"])

        total: dict = {}         # counts of the labels met since the last output
        at = {x: i for i, x in enumerate(labels)}
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                met, lang = np.unique([at[x] for x in part.column(0).to_pylist()], return_inverse=True)
                for lo in range(0, len(met), COLUMNS):
                    here = np.flatnonzero((lang >= lo) & (lang < lo + COLUMNS))
                    texts, own = part.column(1).take(pa.array(here)).to_pylist(), lang[here] - lo
                    new = np.zeros((min(COLUMNS, len(met) - lo), BUCKETS), np.int64)
                    for row, bucket in grams(texts):
                        new += np.bincount(own[row] * BUCKETS + bucket, minlength=new.size).reshape(new.shape)
                    for i, n in zip(met[lo:lo + COLUMNS].tolist(), new):
                        total[i] = total[i] + n if i in total else n.copy()
                    if len(total) > COLUMNS:
                        yield said()
                        total.clear()
        if total:
            yield said()

    return run


def fit(docs: DataFrame, sample: int = SAMPLE):
    """``(labels, matrix, prior)`` learned from the rows whose fold is not 0; the matrix is a list of blocks of columns."""
    import numpy as np

    ship(docs.sparkSession)
    eligible = docs.select("doc_id", "text", "lang").where(
        "lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(_fold(docs) != 0)
    found = sorted((r.lang, r.n) for r in eligible.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    if not found:
        return [], [], np.zeros(0)
    labels = [x for x, _ in found]
    # a hash of the id decides, so that about ``sample`` rows of a language are read
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shares = docs.sparkSession.createDataFrame([(x, min(1.0, sample / n)) for x, n in found], "lang string, share double")
    drawn = eligible.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    rows = (drawn.select("lang", "text").mapInArrow(_counts(labels), "label int, bucket int, n long")
            .groupBy("label", "bucket").agg(F.sum("n").alias("n")))      # at most languages x buckets
    if len(labels) > COLUMNS:
        rows = materialize(rows, "language-counts")
    blocks = []
    for lo in range(0, len(labels), COLUMNS):
        some = rows.where(F.col("label").between(lo, lo + COLUMNS - 1)).toPandas()
        counts = np.zeros((BUCKETS, min(COLUMNS, len(labels) - lo)))
        counts[some["bucket"].to_numpy(), some["label"].to_numpy() - lo] = some["n"].to_numpy()
        logs = np.log(counts + SMOOTH) - np.log(counts.sum(0) + SMOOTH * BUCKETS)
        blocks.append(logs.astype(np.float32))
    n = np.array([x for _, x in found], float)
    return labels, blocks, np.log(n / n.sum())


def predict(texts: list[str | None], labels, matrix, prior, own):
    """``(label, score, surprise)`` of each text; the score is the posterior probability."""
    import numpy as np

    known = [t or "" for t in texts]
    total = np.tile(prior, (len(known), 1))
    size = np.zeros(len(known), np.int64)
    for row, bucket in grams(known):
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            for k, block in enumerate(matrix):
                at = slice(k * COLUMNS, k * COLUMNS + block.shape[1])
                total[row[starts], at] += np.add.reduceat(block[bucket], starts, axis=0, dtype=np.float64)
            size[row[starts]] += np.diff(np.r_[starts, len(row)])
    out = []
    for i, n in enumerate(size):
        if not n or not labels:
            out.append((UNKNOWN, 0.0, None))
            continue
        best = int(np.argmax(total[i]))
        usual, spread = own[best]
        said = (total[i][best] - prior[best]) / n
        out.append((labels[best], float(1.0 / np.exp(total[i] - total[i][best]).sum()),
                    float(usual - said - SPREAD * spread / np.sqrt(n))))
    return out


def moments(matrix):
    """For each language the mean and the standard deviation of the log probability of its own n-grams."""
    import numpy as np

    out = []
    for block in matrix:
        logs = block.astype(np.float64)
        mean = (np.exp(logs) * logs).sum(0)
        out += zip(mean, np.sqrt((np.exp(logs) * logs ** 2).sum(0) - mean ** 2))
    return out


def identify(docs: DataFrame, model=None) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred``, ``score`` and ``surprise`` added (columns of these names are replaced)."""
    spark = docs.sparkSession
    ship(spark)
    labels, matrix, prior = model or fit(docs)
    shared = spark.sparkContext.broadcast((labels, matrix, prior, moments(matrix)))
    rest = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score", "surprise")]
    kinds = dict(docs.dtypes)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts, out = b.column(rest.index("text")), []
            for k in range(0, b.num_rows, 256):
                out += predict(texts.slice(k, 256).to_pylist(), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.float64(), pa.float64()))]],
                [*rest, "held_out", "lang_pred", "score", "surprise"])

    held = F.coalesce(_fold(docs) == 0, F.lit(False)).alias("held_out")
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in rest)
    return docs.select(*[F.col(f"`{c}`") for c in rest], held).mapInArrow(
        run, f"{schema}, held_out boolean, lang_pred string, score double, surprise double")
