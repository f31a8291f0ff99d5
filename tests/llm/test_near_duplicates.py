import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import simhash_dedup as S


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fingerprint) -> smallest doc_id reachable."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i):
            if (a[1] ^ rows[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(rows))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té中", max_size=40)), max_size=6))
def test_fingerprints(texts):
    assert S.fingerprints(pa.array(texts, pa.string())).tolist() == [brute_fingerprint(t) for t in texts]


def test_near_duplicates_edges(edges, empty):
    rows = edges.select("doc_id", "text").collect()
    own = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(own, brute_components(own), strict=True)), key=str)
    assert sorted((tuple(r) for r in S.near_duplicates(edges).collect()), key=str) == want
    assert S.near_duplicates(empty).collect() == []


def test_links_equal_brute_force(spark):
    """Clusters, chains and a crowded cell of near fingerprints."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.int64)
    fps = set(base.tolist()) | {0, -1}
    for b in base[:10].tolist():
        at = b
        for _ in range(12):  # a chain of small steps
            for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                at ^= 1 << bit
            fps.add(int(np.uint64(at & (2**64 - 1)).astype(np.int64)))
    for _ in range(150):  # around one point
        at = int(base[11])
        for bit in rng.choice(63, rng.integers(1, 4), replace=False).tolist():
            at ^= 1 << bit
        fps.add(at)
    fps = sorted(fps)
    want = brute_components([(i, f & (2**64 - 1)) for i, f in enumerate(fps)])
    for slabs in (None, 8):
        check(fps, want, S.link(spark.createDataFrame([(f,) for f in fps], "fp long"), slabs=slabs))


def test_estimates_do_not_grow_with_rounds(spark):
    """Longer chains take more rounds; the size that Spark assumes doubled its digits in each, on the driver."""
    bits = []
    for n in (3, 40):
        nodes = spark.range(n).withColumnRenamed("id", "fp")
        got = S.components(nodes, spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long"))
        assert sorted((r.fp, r.root) for r in got.collect()) == [(i, 0) for i in range(n)]
        bits.append(int(got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length())
    assert max(bits) < 1000 and abs(bits[0] - bits[1]) < 8


def check(fps, want, linked):
    got = {r.fp: r.root for r in linked.collect()}
    assert len(got) == len(fps)
    groups, same = {}, {}
    for i, f in enumerate(fps):
        groups.setdefault(got[f], set()).add(i)
        same.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values()))


def test_slabs_follow_the_number_of_fingerprints():
    picked = [S.slabs_for(10**k, S.DISTANCE) for k in range(12)]
    assert picked == sorted(picked) and picked[0] == 5 and picked[5] == 6 and picked[9] > 8


def test_one_of_each_component_stays(frame, empty):
    a, b = " ".join(f"word{i}" for i in range(80)), " ".join(f"other{i * i}" for i in range(80))
    rows = [(3, a), (1, a), (1, b), (1, b), (2, b), (None, a), (None, "by itself"), (5, None), (6, "")]
    got = S.without_near_duplicates(frame(rows))
    assert got.columns == frame(rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, a), (1, b), (None, "by itself"), (5, None)], key=str)
    assert S.without_near_duplicates(empty).collect() == []


def test_the_bound_is_a_lower_bound(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    rows = [(int(a), int(b)) for a, b in rng.integers(-(2**63), 2**63 - 1, (200, 2), dtype=np.int64)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", S.manhattan(S.embedded(F.col("a")), S.embedded(F.col("b"))).alias("m")).collect()
    for r in got:
        pairs = [((r.a >> 2 * s) & 3, (r.b >> 2 * s) & 3) for s in range(32)]
        assert r.m == sum(abs(x.bit_count() - y.bit_count()) for x, y in pairs) <= ((r.a ^ r.b) & (2**64 - 1)).bit_count()
