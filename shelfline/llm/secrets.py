"""Secret scan: fixed formats, and random-looking tokens by a battery of randomness tests with false-discovery control.

A candidate is a run of at least ``LEAST`` characters of ``A-Za-z0-9+/_-``. Its encoding is the smallest alphabet that holds it. Three
tests ask whether it can be random in that alphabet: chi-squared uniformity, runs about the alphabet's middle, and serial
correlation; a token that fails one at ``LIMIT`` standard deviations is not taken. Uniformity and runs then give a p-value for the
opposite, that it is ordinary text: characters drawn as the rest of the corpus has them, restricted to the alphabet.
Those p-values of all candidates go through the weighted Benjamini-Hochberg procedure, with weights by encoding and length: a
token too short to tell random from ordinary has little weight. The threshold is found on counts per step of the p-value.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.arrays import chunks, runs, text_bytes
from shelfline.plans.staging import Stage, WrittenTables

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_RE2 = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
ACCESS = re.compile("AKIA[A-Z0-9]+")
LEAST, LIMIT, RATE = 16, 3.5, 0.01
#: lengths beyond are of one weight
LONGEST = 256
#: steps of the p-value's negative logarithm, and the last step
STEP, STEPS = 0.01, 30_000

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "decimal": DIGITS, "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "lower": LOWER, "upper": UPPER, "base32": "234567" + UPPER,
    "lower36": DIGITS + LOWER, "upper36": DIGITS + UPPER, "letters": UPPER + LOWER, "base62": DIGITS + UPPER + LOWER,
    "base64": "+/" + DIGITS + UPPER + LOWER, "base64url": "-_" + DIGITS + UPPER + LOWER, "mixed": "+-/_" + DIGITS + UPPER + LOWER}
_IN = np.zeros((len(ALPHABETS), 256), bool)
_PLACE = np.zeros((len(ALPHABETS), 256), np.int64)
for _k, _chars in enumerate(ALPHABETS.values()):
    _codes = np.frombuffer(_chars.encode(), np.uint8)
    _IN[_k, _codes] = True
    _PLACE[_k, _codes] = np.arange(_codes.size)
_HEX = _IN[list(ALPHABETS).index("hex")]
_TOKEN = _IN[-1]

TESTED = "start: int, end: int, encoding: string, n: int, pairs: long, runs: int, serial: double"
FOUND = f"base array<struct<kind: string, start: int, end: int>>, tested array<struct<{TESTED}>>, counts array<long>"
_BASE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_TESTED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("n", pa.int32()),
                              ("pairs", pa.int64()), ("runs", pa.int32()), ("serial", pa.float64())]))


class Moments(NamedTuple):
    """Mean and deviation of a statistic."""

    mean: float
    sd: float

    def z(self, value: float) -> float:
        return (value - self.mean) / max(self.sd, 1e-9)


def pair_moments(shares: np.ndarray, n: int) -> Moments:
    """Pairs of equal characters among ``n`` independent ones. The chi-squared statistic against uniformity over k characters
    is (n + 2 * pairs) * k / n - n, so it and the pairs give the same test."""
    two, three = float((shares ** 2).sum()), float((shares ** 3).sum())
    some = n * (n - 1) / 2
    return Moments(some * two, math.sqrt(max(some * (two - two ** 2) + n * (n - 1) * (n - 2) * (three - two ** 2), 0)))


def run_moments(above: float, n: int) -> Moments:
    """Runs of characters above and below the middle, among ``n`` independent ones."""
    c = above * (1 - above)
    return Moments(1 + 2 * (n - 1) * c, math.sqrt(max(2 * (n - 1) * c * (1 - 2 * c) + 2 * (n - 2) * (c - 4 * c * c), 0)))


def serial_moments(n: int) -> Moments:
    """Serial correlation, the last character followed by the first, of ``n`` independent ones."""
    return Moments(-1 / (n - 1), math.sqrt(n * (n - 3) / (n + 1)) / (n - 1))


def statistics(codes: np.ndarray) -> tuple[str, int, int, int, float]:
    """Encoding, characters, pairs of equal ones, runs and serial correlation of a token's bytes."""
    kind = int(_IN[:, codes].all(1).argmax())
    values = _PLACE[kind][codes]
    n, size = values.size, len(list(ALPHABETS.values())[kind])
    counts = np.bincount(values)
    above = values >= size // 2
    centred = values - values.mean()
    spread = float(centred @ centred)
    serial = float(centred @ np.roll(centred, -1)) / spread if spread else 1.0
    return list(ALPHABETS)[kind], n, int((counts * (counts - 1)).sum() // 2), 1 + int((above[1:] != above[:-1]).sum()), serial


def is_random(encoding: str, n: int, pairs: int, n_runs: int, serial: float) -> bool:
    """Whether all three tests leave it open that the characters are uniform and independent."""
    size = len(ALPHABETS[encoding])
    seen = (pair_moments(np.full(size, 1 / size), n).z(pairs), run_moments(1 - (size // 2) / size, n).z(n_runs), serial_moments(n).z(serial))
    return max(map(abs, seen)) <= LIMIT


def _lower_tail(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _at_least(r: int, mean: float) -> float:
    """P(a Poisson variable >= r)."""
    if r <= 0:
        return 1.0
    if mean > 200:
        return _lower_tail((mean - r + 0.5) / math.sqrt(mean))
    term = math.exp(r * math.log(max(mean, 1e-300)) - mean - math.lgamma(r + 1))
    total, k = 0.0, r
    while term > total * 1e-12 and k < r + 2000:
        total, k = total + term, k + 1
        term *= mean / k
    return min(total, 1.0)


def ordinary_p(shares: np.ndarray, n: int, pairs: int, n_runs: int) -> float:
    """P-value for ordinary text: as few equal pairs, and as many runs, among independent characters of these shares. A change
    of side comes with a change back, so changes count by two; the two are joined by Fisher's method."""
    few = _lower_tail(pair_moments(shares, n).z(pairs))
    above = float(shares[shares.size // 2:].sum())
    many = _at_least((n_runs - 1) // 2, (n - 1) * above * (1 - above))
    both = max(few * many, 1e-290)
    return min(1.0, both * (1 - math.log(both)))


def shares_of(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Shares of the characters of each alphabet, from counts per byte, each counted once more than seen."""
    out = {}
    for name, chars in ALPHABETS.items():
        own = counts[np.frombuffer(chars.encode(), np.uint8)] + 1.0
        out[name] = own / own.sum()
    return out


@functools.lru_cache(100_000)
def _weight(shares: tuple, n: int) -> float:
    """Chance that a random token of this length has few enough pairs to be told from ordinary text at p = 0.01."""
    own = np.array(shares)
    ordinary, flat = pair_moments(own, n), pair_moments(np.full(own.size, 1 / own.size), n)
    return max(_lower_tail((ordinary.mean - 2.326 * ordinary.sd - flat.mean) / flat.sd), 0.01)


def weight(shares: np.ndarray, n: int) -> float:
    return _weight(tuple(shares.round(6)), min(n, LONGEST))


def _letter(raw: bytes, last: bool) -> bool:
    text = raw.decode(errors="ignore")
    return bool(text) and text[-1 if last else 0].isalnum()


def _scan(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            column = batch.column("text")
            offsets, data = text_bytes(column)
            offsets = offsets.astype(np.int64)
            before = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80, dtype=np.int32)])
            base: list[list] = [[] for _ in range(batch.num_rows)]
            tested: list[list] = [[] for _ in range(batch.num_rows)]

            def owned(mask):
                first, past = runs(mask[data], offsets)
                long = past - first >= LEAST
                first, past = first[long], past[long]
                owner = np.searchsorted(offsets, first, side="right") - 1
                shift = offsets[owner] - before[offsets[owner]]
                return zip(owner, first, past, first - before[first] - shift, past - before[past] - shift)

            for k in np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, ASSIGN_RE2), False).to_numpy(zero_copy_only=False)):
                base[k] += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(column[k].as_py()) if len(m[1]) >= 12]
            for k in np.flatnonzero(pc.fill_null(pc.match_substring(column, "AKIA"), False).to_numpy(zero_copy_only=False)):
                base[k] += [("access", m.start(), m.end()) for m in ACCESS.finditer(column[k].as_py()) if m.end() - m.start() >= 18]
            for k, _, _, start, end in owned(_HEX):
                base[k].append(("hex", int(start), int(end)))
            counts = np.bincount(data, minlength=256)
            for k, first, past, start, end in owned(_TOKEN):
                codes = data[first:past]
                counts -= np.bincount(codes, minlength=256)
                if _letter(data[max(first - 4, offsets[k]):first].tobytes(), True) or _letter(data[past:min(past + 4, offsets[k + 1])].tobytes(), False):
                    continue  # a part of a longer word
                padding = len(re.match(b"=?=?", data[past:min(past + 2, offsets[k + 1])].tobytes())[0])
                tested[k].append((int(start), int(end) + padding, *statistics(codes)))
            for spans in base:
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
            made = {"base": pa.array(base, _BASE), "tested": pa.array(tested, _TESTED), "counts": pa.nulls(batch.num_rows, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([made[x] if x in made else batch.column(x) for x in names], names)
            told = {"counts": pa.array([counts.tolist()], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([told[x] if x in told else pa.nulls(1, made[x].type if x in made else batch.column(x).type)
                                              for x in names], names)
    return run


def _steps(shares: dict[str, np.ndarray], mean: float):
    """Number of tokens per step of the weighted p-value's logarithm."""
    def run(batches):
        for batch in batches:
            table = np.zeros(STEPS + 1, np.int64)
            for tokens in batch.column("tested").to_pylist():
                for t in tokens or ():
                    table[_step(shares, mean, t)] += 1
            steps = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(steps.astype(np.int32)), pa.array(table[steps])], ["step", "n"])
    return run


def _step(shares: dict[str, np.ndarray], mean: float, t: dict) -> int:
    own = shares[t["encoding"]]
    if not is_random(t["encoding"], t["n"], t["pairs"], t["runs"], t["serial"]):
        return 0
    p = ordinary_p(own, t["n"], t["pairs"], t["runs"]) / (weight(own, t["n"]) / mean)
    return min(max(int(-math.log10(max(p, 1e-300)) / STEP), 0), STEPS)


def threshold(steps: np.ndarray, n: np.ndarray, rate: float) -> int:
    """First step from which on the expected share of ordinary tokens among those taken is at most ``rate``."""
    table = np.zeros(STEPS + 2, np.int64)
    table[steps] = n
    taken = np.cumsum(table[::-1])[::-1]
    good = (10.0 ** (-STEP * np.arange(STEPS + 2)) * taken[0] <= rate * taken) & (taken > 0)
    good[0] = False
    return int(good.argmax()) if good.any() else STEPS + 1


def _decide(names: list[str], shares: dict[str, np.ndarray], mean: float, least: int):
    def run(batches):
        for batch in batches:
            out = []
            for base, tokens in zip(batch.column("base").to_pylist(), batch.column("tested").to_pylist(), strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                for t in tokens:
                    free = all(t["end"] <= s["start"] or s["end"] <= t["start"] for s in base)
                    if free and _step(shares, mean, t) >= least:
                        spans.append(("random", t["start"], t["end"]))
                out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
            made = pa.array(out, _BASE)
            yield pa.RecordBatch.from_arrays([made if x == "spans" else batch.column(x) for x in names], names)
    return run


def scan(docs: DataFrame, rate: float = RATE, stage: Stage | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base and spans, arrays of (kind, start, end) in code points, end exclusive, in
    order of start, then of ``KINDS``.

    ``base`` has the matches of the fixed formats: leftmost non-overlapping per kind, assignments of a value of 12 characters or
    more, access keys of 18, hexadecimal digits of 16. ``spans`` adds the tokens (kind ``random``) that pass the battery and
    the false-discovery control at ``rate`` and overlap no base span. Null and empty texts have no spans. Which tokens are added depends
    on the whole table: on how its text is made up, and on how many candidates there are. Extra columns are left out.

    Texts are read once; what the driver gets is 256 counts, and counts per encoding and length and per step of the p-value.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    found = stage(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(
        _scan(["doc_id", "base", "tested", "counts"]), f"doc_id {kind}, {FOUND}"), "secrets")
    total = found.where("counts IS NOT NULL").select(F.posexplode("counts").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(256)
    for row in total:
        counts[row.k] = row.n
    shares = shares_of(counts)
    rows = found.where("counts IS NULL")
    some = rows.where(F.size("tested") > 0)
    groups = some.select(F.explode("tested").alias("t")).groupBy("t.encoding", F.least("t.n", F.lit(LONGEST)).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()
    tokens = sum(g.c for g in groups)
    mean = sum(g.c * weight(shares[g.encoding], g.n) for g in groups) / max(tokens, 1) or 1.0
    steps = some.select("tested").mapInArrow(_steps(shares, mean), "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).toArrow()
    least = threshold(steps["step"].to_numpy(), steps["n"].to_numpy(), rate)
    return rows.select("doc_id", "base", "tested").mapInArrow(
        _decide(["doc_id", "base", "spans"], shares, mean, least),
        f"doc_id {kind}, base array<struct<kind: string, start: int, end: int>>, spans array<struct<kind: string, start: int, end: int>>")


def told(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
