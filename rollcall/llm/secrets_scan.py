"""Secret scan with a battery of randomness tests (operator 9).

Base kinds are found by pattern in every whole text, leftmost and
non-overlapping per kind: ``assign`` (a secret-like name, a separator and a
value of 8 or more characters; the span is the whole match), ``access``
(``AKIA`` and more, 16 or more characters) and ``hex`` (32 or more of 0-9a-f).

The method adds spans of kind ``random``: tokens (also as the value of
``NAME=VALUE``, whatever the name) of ``MIN_TOKEN`` or more characters of an inferred encoding (hexadecimal, base32, base36 or base64 in
either alphabet) that mix letters and digits and in which randomness can't be
rejected.  The battery:

* chi-squared: symbols spread evenly over the encoding's alphabet;
* runs: Wald-Wolfowitz runs above and below the alphabet's middle;
* serial correlation of neighbouring symbols at lag one.

Each token's three p-values are combined by Fisher's method.  The multiple
testing over a corpus is settled by Benjamini-Hochberg at ``FDR`` within each
stratum of encoding and length (powers of two): the share of truly random
tokens among those that are set aside as not random stays below ``FDR`` at
each length, so that long tokens, whose tests have more power, don't decide
for short ones.  The thresholds come from a histogram over all tokens of the
corpus with a fixed number of cells, so that nothing grows at the driver.

Defined results: null texts count as empty and have no spans; repeated rows
each get their row; spans are code points, end exclusive; a token that touches
a base span isn't added; columns besides the id and text are ignored by
``scan`` and kept by ``mask``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import free_name, map_batches, stash

# Fixed patterns and kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED = 8

MIN_TOKEN = 20
FDR = 0.05
P_CELLS = 200  # of -ln p, 0.1 wide: p-values below e**-20 share the last cell
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{%d,}={0,2}(?![A-Za-z0-9+/_=-])" % MIN_TOKEN)
MASK = "[SECRET]"

_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (  # name, alphabet; the first that holds every symbol is inferred
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _UPPER.lower()),
    ("BASE36", _DIGITS + _UPPER),
    ("base64", _UPPER + _UPPER.lower() + _DIGITS + "+/"),
    ("base64url", _UPPER + _UPPER.lower() + _DIGITS + "-_"),
)
_CODES = []
for _, _alphabet in ENCODINGS:
    _codes = np.full(256, -1, np.int16)
    _codes[np.frombuffer(_alphabet.encode(), np.uint8)] = np.arange(len(_alphabet))
    _CODES.append(_codes)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(symbols: np.ndarray, size: int) -> float:
    """Upper tail of Pearson's statistic (Wilson-Hilferty approximation).
    Alphabets larger than the token allows are folded so that each cell
    expects two symbols or more."""
    cells = max(2, min(size, len(symbols) // 2))
    counts = np.bincount(symbols.astype(np.int64) * cells // size, minlength=cells)
    share = np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    expected = share * len(symbols)
    x, df = float(((counts - expected) ** 2 / expected).sum()), cells - 1
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return _normal_tail(z)


def runs_p(symbols: np.ndarray, size: int) -> float:
    """Two-sided Wald-Wolfowitz test on symbols above the alphabet's middle."""
    high = symbols * 2 >= size
    n, a = len(high), int(high.sum())
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    if var <= 0:
        return 1.0
    z = abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)
    return min(1.0, 2 * _normal_tail(z))


def serial_p(symbols: np.ndarray) -> float:
    """Two-sided test of the lag-one correlation, about N(-1/n, 1/n)."""
    x = symbols - symbols.mean()
    n, total = len(x), float((x * x).sum())
    if total == 0:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / total
    return min(1.0, 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n)))


def randomness(token: str) -> tuple[int, float] | None:
    """(encoding, combined p-value of randomness), or None where no encoding
    with both letters and digits fits."""
    raw = np.frombuffer(token.rstrip("=").encode(), np.uint8)
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    if not 0 < digits < len(raw):
        return None
    for e, codes in enumerate(_CODES):
        symbols = codes[raw]
        if (symbols >= 0).all():
            size = len(ENCODINGS[e][1])
            p = [max(1e-300, x) for x in (chi_squared_p(symbols, size), runs_p(symbols, size), serial_p(symbols))]
            half = -sum(map(math.log, p))  # Fisher: chi-squared with 6 degrees
            return e, min(1.0, math.exp(-half) * (1 + half + half * half / 2))
    return None


def _stratum(encoding: int, length: int) -> int:
    return encoding * 64 + length.bit_length()


def _cell(p: float) -> int:
    """Cell of -ln p, rounded down: the cell's p is not below the true one."""
    return min(P_CELLS - 1, int(-10 * math.log(max(p, 1e-300))))


def tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, p cell) of the tested tokens of a text."""
    out = []
    for m in TOKEN.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        got = randomness(m.group())
        if got:
            out.append((m.start(), m.end(), _stratum(got[0], m.end() - m.start()), _cell(got[1])))
    return out


def rejected_cells(histogram: dict[int, dict[int, int]], fdr: float = FDR) -> dict[int, int]:
    """Benjamini-Hochberg per stratum on binned p-values: the smallest cell
    (largest p) at which randomness is rejected."""
    out = {}
    for stratum, counts in histogram.items():
        total, seen = sum(counts.values()), 0
        out[stratum] = P_CELLS
        for cell in sorted(counts, reverse=True):
            seen += counts[cell]
            if math.exp(-cell / 10) <= fdr * seen / total:
                out[stratum] = cell
    return out


_SPANS = "array<struct<start:bigint,kind:int,end:bigint,stratum:int,cell:int>>"
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                   ("stratum", pa.int32()), ("cell", pa.int32())])


def find(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``spans`` (with underscores before
    it if that name is taken): all spans of each text, by start, then kind, as
    struct(start, kind index, end, stratum, cell)."""
    name = free_name(keep, "spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in batch.column(at):
            t = t.as_py() or ""
            base = base_spans(t)
            rows.append([{"start": s, "kind": k, "end": e} for s, k, e in base]
                        + [{"start": s, "kind": 3, "end": e, "stratum": g, "cell": c}
                           for s, e, g, c in tokens(t, base)])
        return pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + [pa.array(rows, type=pa.list_(_SPAN))],
                                          names=[*batch.schema.names[:len(keep)], name])

    src = docs.select(*dict.fromkeys([*keep, text]))
    at = src.columns.index(text)
    schema = T.StructType([*src.schema.fields[:len(keep)],
                           T.StructField(name, T._parse_datatype_string(_SPANS))])
    found = stash(map_batches(src, run, schema), "spans")
    cells = (found.select(F.explode(name).alias("s")).where("s.kind = 3")
             .groupBy("s.stratum", "s.cell").agg(F.count("*").alias("n")).collect())  # 7 * 64 * P_CELLS at most
    histogram: dict[int, dict[int, int]] = {}
    for stratum, cell, n in cells:
        histogram.setdefault(stratum, {})[cell] = n
    limits = rejected_cells(histogram)
    spans = F.col(name)
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        spans = F.filter(name, lambda s: (s["kind"] != 3) | (s["cell"] < limit[s["stratum"]]))
    return found.select(*keep, F.sort_array(spans).alias(name))


def _joined(spans, kinds):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    name = free_name((doc_id,), "spans")
    found = find(docs, text, keep=(doc_id,))

    def count(kind: int):
        return F.size(F.filter(name, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col(doc_id).alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter(name, lambda s: s["kind"] < 3), kinds), 256).alias("base_sha256"),
        _joined(name, kinds).alias("spans"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of a text replaced by ``MASK`` (overlapping
    spans by one); texts without spans, null ones included, stay as they are.
    ``n_chars``, where there is such a column, follows the new text."""
    names = docs.columns
    found = find(docs, text, keep=tuple(names))
    at, name = names.index(text), free_name(names, "spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
            if spans:
                parts, done = [], 0
                for s in spans:
                    if s["start"] >= done:
                        parts += [t[done:s["start"]], MASK]
                    done = max(done, s["end"])
                t = "".join(parts) + t[done:]
            out.append(t)
        columns = batch.columns[:-1]
        columns[at] = pa.array(out, type=pa.string())
        return pa.RecordBatch.from_arrays(columns, names=names)

    dirty = map_batches(found.where(F.size(name) > 0), run, docs.schema)
    if "n_chars" in names and text != "n_chars":
        dirty = dirty.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return found.where(F.size(name) == 0).select(*names).unionByName(dirty.select(*names))
