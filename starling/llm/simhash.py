"""SimHash near-dedup with the generalised pigeonhole principle.

A text is lower-cased (A-Z), cut into words and into shingles of
``shingle`` words (repeats included; fewer words: the whole sequence).  Bit b
of its 64-bit fingerprint is 1 when over half of the shingles' XXH64 hashes
have it.  A text without words has fingerprint zero.  Fingerprints link at
``max_bits`` or fewer differing bits; a group is a connected component.

Search (generalised pigeonhole).  The 64 bits are put into m parts.  If
thresholds t_1..t_m (each -1 or more; -1 skips the part) sum to
``max_bits - m + 1``, any two fingerprints within ``max_bits`` differ in at
most t_i bits in some part i.  Correlated bits go to the same part, which
leaves the others closer to independent, and a dynamic program picks the
thresholds with the least estimated number of candidate pairs.  Both come
from statistics: bit correlations over all distinct fingerprints, candidate
estimates from a hash sample of about ``ESTIMATE_ROWS`` of them.  They steer the
cost only; every allocation finds every link.

Groups.  Exact copies share a fingerprint and are one node.  A part value held
by at most ``CROWD`` fingerprints yields its pairs, verified on all 64 bits.
Fingerprints of a fuller value take an exact way that never enumerates pairs:
each emits itself and its one-bit neighbours; two fingerprints within two bits
share one of those, and those sharing one are at most two bits apart (for
``max_bits`` 1, the pairs are verified).  A neighbour is shared by at most 65
fingerprints, so this is linear however large the group is.

Defined cases: null and empty texts and texts of white space only have
fingerprint zero and link like any other; a document with a null id gets a
fingerprint, and the component id is the least id that is not null (null when
there is none); repeated rows are equal nodes, one result row each; an empty
table gives an empty result; other columns are ignored by
:func:`fingerprints` and :func:`near_duplicates`, carried by :func:`keep_rows`.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starling.llm.common import arrow_map, edges_to_components, text_or_empty, written

SEED = 42
PARTS = 3
CROWD = 32
ESTIMATE_ROWS = 65_536
BITS = 64


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text that is already lower-cased."""
    words = text.split()  # bytes.split() cuts at space and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                                       ends[shingle - 1:].tolist())]
    return _majority(np.array(hashes, dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    count = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):  # bounded memory for a very long text
        part = hashes[at:at + 65_536]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 carry: tuple[Column, ...] = ()) -> DataFrame:
    """``(id, fp)`` per row, ``fp`` the fingerprint as a signed long; ``carry`` adds narrow columns."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), *carry)
    rest = [f for f in rows.schema.fields if f.name != "text"]

    def batch(b: pa.RecordBatch):
        texts = pc.ascii_lower(b.column("text")).cast(pa.binary())
        fps = [fingerprint(x.as_py(), shingle) for x in texts]
        out = [b.column(f.name) for f in rest] + [pa.array(np.array(fps, dtype=np.uint64).view(np.int64))]
        yield pa.RecordBatch.from_arrays(out, names=[f.name for f in rest] + ["fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", fp long"
    return arrow_map(rows, batch, schema)


# ---------------------------------------------------------------- parts and thresholds
def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 matrix of joint bit counts, over all of them.

    Each task sends one matrix per partition; the driver adds 4096 numbers.
    """
    def run(batches):
        n, joint = 0, np.zeros((BITS, BITS))
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 8192):
                x = np.unpackbits(fps[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float32)
                joint += (x.T @ x).astype(np.float64)
                n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS + 1, dtype=np.int32)),
             pa.array(np.concatenate((joint.ravel(), [n])))], names=["cell", "n"])
    rows = distinct.select("fp").mapInArrow(run, "cell int, n double").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, joint: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        seed = max(left, key=lambda b: (corr[b, sorted(left)].sum(), -b))
        part = [seed]
        left.remove(seed)
        while len(part) < size:
            best = max(left, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def allocate(cost: list[list[float]], max_bits: int) -> list[int]:
    """Thresholds by dynamic programming: ``cost[i][t + 1]`` estimates the candidates
    of part i at threshold t; the thresholds sum to ``max_bits - parts + 1``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (value, picks) in best.items():
            for k, c in enumerate(row):  # k = threshold + 1
                if total + k <= max_bits + 1 and (total + k not in step or value + c < step[total + k][0]):
                    step[total + k] = (value + c, [*picks, k - 1])
        best = step
    return best[max_bits + 1][1]


def estimate_candidates(sample: np.ndarray, parts: list[list[int]], max_bits: int, n: int) -> list[list[float]]:
    """Estimated probes and candidate pairs per part and threshold, scaled from a sample to n fingerprints."""
    scale = (n / max(len(sample), 1)) ** 2
    cost = []
    for part in parts:
        mask = np.uint64(sum(1 << b for b in part))
        values, counts = np.unique(sample & mask, return_counts=True)
        row = [0.0]
        for t in range(max_bits + 1):
            if t > 1:  # a ball of two bits is never cheaper than the exact neighbour way
                row.append(row[-1] * len(part) + n * len(part) ** t)
                continue
            pairs = float((counts.astype(float) * (counts - 1)).sum() / 2)
            for b in part if t else ():
                at = np.searchsorted(values, values ^ np.uint64(1 << b))
                at[at == len(values)] = 0
                hit = values[at] == values ^ np.uint64(1 << b)
                pairs += float((counts[hit].astype(float) * counts[at[hit]]).sum() / 2)
            row.append(pairs * scale + n * (1 + t * len(part)))
        cost.append(row)
    return cost


# ---------------------------------------------------------------- links
def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def _ball(bits: list[int], radius: int) -> list[int]:
    """Masks that flip at most ``radius`` of ``bits``."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(bits, r)]


def _probes(part: int, bits: list[int], radius: int) -> Column:
    """The values of a part that a fingerprint visits: its own, and all within ``radius`` bits."""
    value = F.col("fp").bitwiseAND(_long(sum(1 << b for b in bits)))
    return F.transform(F.array(*[_long(m) for m in _ball(bits, radius)]), lambda m: F.struct(
        F.lit(part).alias("part"), value.bitwiseXOR(m).alias("value"), (m == 0).alias("own")))


def links(distinct: DataFrame, max_bits: int = 2, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """Links ``(src, dst)`` between distinct fingerprints (column ``fp``).

    Fingerprints within ``max_bits`` are connected by the links; pairs in a
    crowded part value are connected through a shared neighbour instead of
    being listed one by one.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    n, joint = bit_statistics(distinct)
    groups = correlated_parts(n, joint, parts)
    drawn = distinct.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(max(n, 1))) < ESTIMATE_ROWS)
    sample = np.array([r["fp"] for r in drawn.limit(2 * ESTIMATE_ROWS).collect()], dtype=np.int64).view(np.uint64)
    radii = allocate(estimate_candidates(sample, groups, max_bits, n), max_bits)

    probes = []
    for i, (bits, radius) in enumerate(zip(groups, radii)):
        if radius < 0:
            continue
        probes.append(_probes(i, bits, radius))
    keyed = distinct.select("fp", F.explode(F.concat(*probes)).alias("k")).select("fp", "k.*")
    held = keyed.groupBy("part", "value").agg(
        F.sum(F.col("own").cast("long")).alias("owners"), F.count(F.lit(1)).alias("n"))
    # a value with a single visitor, or that no fingerprint owns, makes no pair
    met = written(keyed.join(held.where("n > 1 and owners > 0"), ["part", "value"]).select(
        "fp", "part", "value", "own", "n"), "simhash-probes")
    few, many = met.where(F.col("n") <= crowd), met.where(F.col("n") > crowd)
    a = few.select("part", "value", F.col("fp").alias("src"))
    b = few.where("own").select(F.col("part").alias("p"), F.col("value").alias("v"), F.col("fp").alias("dst"))
    verified = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    # balls are symmetric, so every pair is met from both sides
    pairs = a.join(b, (F.col("part") == F.col("p")) & (F.col("value") == F.col("v"))
                   & (F.col("src") < F.col("dst")) & verified).select("src", "dst")
    return pairs.union(_crowded_links(many.select("fp").distinct(), max_bits))


def _crowded_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of crowded values, through shared one-bit neighbours (exact, linear)."""
    if max_bits == 0:
        return fps.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).limit(0)
    masks = F.array(*[_long(m) for m in _ball(list(range(BITS)), 1)])
    near = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"))
    # at most 65 fingerprints lie within one bit of a hub
    met = near.groupBy("hub").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    if max_bits == 2:  # all of a hub's fingerprints are within two bits: a star links them
        return met.select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst")).where("src != dst")
    pairs = met.select(F.explode("fps").alias("src"), "fps").select("src", F.explode("fps").alias("dst"))
    return pairs.where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) == 1)


def components(fps: DataFrame, max_bits: int = 2, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """``(fp, component)`` per distinct fingerprint; ``component`` is a fingerprint of the group."""
    distinct = written(fps.select("fp").distinct(), "simhash-distinct")
    found = edges_to_components(links(distinct, max_bits, parts, crowd))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    labelled = components(fps, max_bits, parts, crowd).join(least, "fp")
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = written(labelled.join(ids, "component").select("fp", "component_id"), "simhash-groups")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
              max_bits: int = 2, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """The rows of ``docs`` that stay: of every group the row with the least id.

    Rows without an id come after all others; equal ids are ordered by content.
    Rows equal in id and text stay or go together.
    """
    content = F.xxhash64(text_or_empty(text_col)).alias("content")
    fps = written(fingerprints(docs, id_col, text_col, shingle, carry=(content,)), "simhash-fps")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "content"))
    best = fps.groupBy("fp").agg(first.alias("best"))
    labelled = components(fps, max_bits, parts, crowd).join(best, "fp")
    stay = labelled.groupBy("component").agg(F.min("best").alias("best")).select(
        F.col("best.id").alias("__sim_stay_id"), F.col("best.content").alias("__sim_stay")).distinct()
    mark = docs.select(*[F.col(f"`{c}`") for c in docs.columns],
                       F.xxhash64(text_or_empty(text_col)).alias("__sim_content"))
    return mark.join(stay, F.col(f"`{id_col}`").eqNullSafe(F.col("__sim_stay_id")) & (
        F.col("__sim_content") == F.col("__sim_stay")), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
