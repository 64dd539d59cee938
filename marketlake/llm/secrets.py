"""Secret scans with a randomness test battery (operator 7).

Base patterns (assignments, access keys, long hexadecimal runs) are found as they
stand. Beyond them, every other long token is a candidate. Its encoding is
inferred (decimal, hexadecimal, upper or lower case, base32, base36, letters, base64), and three tests of
randomness are made on its symbols: chi-squared uniformity over the encoding's
alphabet, Wald-Wolfowitz runs about the median and lag-one serial correlation. A
token that any of them shows not to be random is dropped. For the others, the
p-value under "ordinary text" is taken: the probability that text symbols, which
are far from uniform, look at least as uniform at this length. Over all candidates of
the corpus these p-values go through a weighted Benjamini-Hochberg procedure whose
weights grow with the length, since short tokens tell little.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import bound_batches, by_batch, fresh, strings, with_fields
from marketlake.session import cut_lineage

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no look
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "random")

# Alphabets in the order they are tried: the first that holds all symbols.
ALPHABETS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("base36", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
# Per symbol, the chi-squared divergence from uniform that ordinary text has in an
# alphabet (text fills few symbols of a large alphabet, hence the growth).
TEXT_DIVERGENCE = {"decimal": 0.6, "hex": 1.2, "upper": 0.9, "base32": 1.4, "lower": 0.9, "base36": 1.6, "letters": 2.0, "base64": 2.6}
RANDOM_LEVEL = 0.001  # below, a test has shown that the token is not random
BINS = 400  # p-values are counted in bins of a twentieth of a decade


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_upper(x: float, k: float) -> float:
    """P(chi-squared of k degrees > x), Wilson-Hilferty."""
    return _upper_normal(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))) if x > 0 else 1.0


def battery(token: str) -> tuple[str, float, float] | None:
    """(encoding, p of the worst randomness test, p under ordinary text); None: no known alphabet."""
    symbols = token.rstrip("=")
    found = next(((n, a) for n, a in ALPHABETS if not set(symbols) - set(a)), None)
    if found is None or not symbols:
        return None
    name, alphabet = found
    place = {c: i for i, c in enumerate(alphabet)}
    x, n, a = [place[c] for c in symbols], len(symbols), len(alphabet)
    chi = sum(symbols.count(c) ** 2 for c in set(symbols)) * a / n - n
    p_chi = _chi2_upper(chi, a - 1)
    up = [v >= a / 2 for v in x]
    n1 = sum(up)
    n0 = n - n1
    if n0 and n1:
        runs = 1 + sum(p != q for p, q in zip(up, up[1:]))
        mean = 1 + 2 * n0 * n1 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper_normal(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    m = (a - 1) / 2
    serial = sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / ((a * a - 1) / 12 * math.sqrt(n - 1)) if n > 1 else 0.0
    p_serial = 2 * _upper_normal(abs(serial))
    # Ordinary text: chi has the non-centrality n * divergence.
    lam, k = n * TEXT_DIVERGENCE[name], a - 1
    p_text = _upper_normal((k + lam - chi) / math.sqrt(2 * (k + 2 * lam)))
    return name, min(p_chi, p_runs, p_serial), max(p_text, 1e-20)


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, float]]]:
    """(base spans, candidates with their p under ordinary text)."""
    low = text.lower()
    base = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if any(k in low for k in KEYWORDS) else []
    if "AKIA" in text:
        base += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    base.sort(key=lambda s: (s[1], order[s[0]]))
    more = []
    # Candidates come in order and apart, base spans by start: one sweep, in which ``reach`` is the
    # furthest end of the base spans that start before the candidate ends.
    at, reach = 0, -1
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][1] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            found = battery(m[0])
            if found and found[1] >= RANDOM_LEVEL:
                more.append((m.start(), m.end(), found[2]))
    return base, more


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_secrets(df: DataFrame, text: str = "text", fdr: float = 0.01) -> DataFrame:
    """Appends n_assign, n_access, n_hex (long), base_sha256, spans (strings), n_random (long).

    spans lists all secrets as kind:start:end (code points, end exclusive) by
    start, then kind as listed in KINDS. The added kind is ``random``. A null or empty text has
    none; repeated rows get the same spans and count each for itself in the false
    discovery rate; other columns pass through, those named like a result are
    replaced; an empty table gives an empty one. One pass over the texts is written
    (spans only, not the texts), one bounded histogram fixes the threshold.
    """
    bound_batches(df.sparkSession)
    own = fresh("scan")

    def make():
        def each(batch: pa.Array) -> pa.Array:
            found = [scan(t) for t in strings(batch)]
            texts = [joined(b) for b, _ in found]
            counts = [[sum(k == kind for k, _, _ in b) for b, _ in found] for kind in KINDS[:3]]
            cands = [[{"start": s, "end": e, "bin": min(BINS - 1, int(-20 * math.log10(p))), "size": (e - s) // 8} for s, e, p in m] for _, m in found]
            return pa.StructArray.from_arrays(
                [*[pa.array(c, pa.int64()) for c in counts], pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]), pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in b] for b, _ in found], BASE_TYPE), pa.array(cands, CAND_TYPE)],
                ["n_assign", "n_access", "n_hex", "base_sha256", "base", "cands"])

        return each

    kind = ("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,base:array<struct<kind:string,start:int,end:int>>,"
            "cands:array<struct<start:int,end:int,bin:int,size:int>>>")
    scanned = cut_lineage(df.withColumn(own, F.arrow_udf(by_batch(make), kind, F.ArrowUDFType.SCALAR_ITER)(F.col(text))).drop(text))
    # At most BINS x SIZES rows reach the driver.
    size = F.least(F.col("c.size"), F.lit(SIZES - 1))
    histogram = scanned.select(F.explode(f"{own}.cands").alias("c")).groupBy(F.col("c.bin").alias("bin"), size.alias("size")).count().collect()
    least = smallest_bins({(r["bin"], r["size"]): r["count"] for r in histogram}, fdr)
    bound = F.array(*[F.lit(x) for x in least])
    extra = F.transform(
        F.filter(F.col(f"{own}.cands"), lambda c: c["bin"] >= F.element_at(bound, F.least(c["size"], F.lit(SIZES - 1)) + 1)),
        lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("rank"), F.lit("random").alias("kind"), c["end"].alias("end")))
    rank = (lambda s: F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1).otherwise(2))
    base = F.transform(F.col(f"{own}.base"), lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    spans = F.array_sort(F.concat(base, extra))
    out = scanned.withColumns({c: F.col(f"{own}.{c}") for c in ("n_assign", "n_access", "n_hex", "base_sha256")})
    out = out.withColumn("n_random", F.size(extra).cast("long"))
    return out.withColumn("spans", F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")).drop(own)


BASE_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
CAND_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32()), ("size", pa.int32())]))
SIZES = 16  # length classes of eight characters; the last holds all longer tokens


def smallest_bins(histogram: dict[tuple[int, int], int], fdr: float) -> list[int]:
    """Per length class, the least bin that passes weighted Benjamini-Hochberg (BINS: none does).

    A class weighs by its number, and the weights average 1 over the candidates. A candidate of p-value
    p and weight w passes at the threshold t if p <= w * t; t is the largest with
    t * candidates <= fdr * those that pass. A bin counts with its largest p-value.
    """
    total = sum(histogram.values())
    if not total:
        return [BINS] * SIZES
    mean = sum((s + 1) * n for (_, s), n in histogram.items()) / total
    ratio = sorted((10 ** (-b / 20) * mean / (s + 1), b, s, n) for (b, s), n in histogram.items())
    passing, threshold = 0, 0.0
    for q, _, _, n in ratio:
        passing += n
        if q * total <= fdr * passing:
            threshold = q
    least = [BINS] * SIZES
    for q, b, s, _ in ratio:
        if q <= threshold:
            least[s] = min(least[s], b)
    return least
