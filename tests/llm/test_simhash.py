import random
import re

import pytest
import xxhash

from talus.llm import graph, simhash

from ..conftest import DATA
from .rows import LONG, awkward

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_fingerprint(text, n=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def expected(pairs):
    fps = {}
    for i, t in pairs:
        fps.setdefault(brute_fingerprint(t), []).append(i)
    root = brute_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for fp, ids in fps.items():
        least.setdefault(root[fp], []).extend(i for i in ids if i is not None)
    return sorted(((i, f"{fp:016x}", min(least[root[fp]], default=None)) for fp, ids in fps.items() for i in ids), key=repr)


@pytest.mark.parametrize("table", ["sf0.001", "awkward"])
def test_groups(spark, table):
    df = awkward(spark) if table == "awkward" else spark.read.parquet(str(DATA / table / "documents.parquet"))
    got = sorted((tuple(r) for r in simhash.near_groups(df).collect()), key=repr)
    assert got == expected((r["doc_id"], r["text"]) for r in df.collect())


def test_long_texts_in_blocks(monkeypatch):
    whole = simhash.fingerprint(LONG)
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    assert simhash.fingerprint(LONG) == whole == brute_fingerprint(LONG)


@pytest.mark.parametrize(("distance", "count"), [(4, 3), (4, 2), (4, 5), (3, 1), (1, 2), (0, 1)])
def test_no_pair_is_lost(spark, distance, count):
    rng = random.Random(distance * 10 + count)
    fps = {0, (1 << 64) - 1}
    while len(fps) < 120:
        base = rng.getrandbits(64)
        fps |= {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(6)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    if distance > 2 and count == 1:
        signed = signed[:25]  # one segment enumerates whole balls
        fps = {s % (1 << 64) for s in signed}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.near_pairs(df, distance, count).collect()}
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance}
    assert {tuple(sorted(p)) for p in got} == want


def test_a_dense_group_emits_few_of_its_pairs(spark):
    rng = random.Random(5)
    fps = {sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(300)} | {rng.getrandbits(63) for _ in range(50)}
    chains = simhash.chained(spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long"))
    pairs = simhash.near_pairs(chains).collect()
    links = {(r["u"], r["v"]) for r in pairs} | {(r["fp"], r["chain"]) for r in chains.where("chain != fp").collect()}
    every = sum((a ^ b).bit_count() <= 4 for a in fps for b in fps if a < b)
    assert len(pairs) < every / 3
    have = {frozenset(x % (1 << 64) for x in e) for e in links}
    assert brute_components(sorted(fps), lambda a, b: frozenset((a, b)) in have) == brute_components(
        sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4
    )


def test_segments_cover_64_bits():
    for distance in range(6):
        for count in range(1, distance + 2):
            plan = simhash.segments(count, distance)
            assert sum(b for _, b, _ in plan) == 64 and sum(r + 1 for *_, r in plan) == distance + 1
    with pytest.raises(ValueError, match="segments"):
        simhash.segments(6, 4)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(100)] + [(5000, 5000 + i) for i in range(50)] + [(7, 7), (9, None)]
    df = spark.createDataFrame(edges, "u long, v long")
    nodes = {n for a, b in edges if b is not None and a != b for n in (a, b)}
    have = {frozenset(e) for e in edges}
    want = brute_components(sorted(nodes), lambda a, b: frozenset((a, b)) in have)
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == {n: r for n, r in want.items() if n != r} or {n: got.get(n, n) for n in nodes} == want


def test_hot_buckets_lose_no_component(spark, monkeypatch):
    """Buckets beyond HOT and WINDOW: their main chain doesn't meet itself, every group still holds together."""
    monkeypatch.setattr(simhash, "HOT", 8)
    monkeypatch.setattr(simhash, "WINDOW", 16)
    rng = random.Random(9)
    fps = {sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(250)}
    fps |= {(1 << 40) - 1 ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(120)} | {rng.getrandbits(63) for _ in range(60)}
    chains = simhash.chained(spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")).cache()
    links = {(r["u"], r["v"]) for r in simhash.near_pairs(chains).collect()}
    links |= {(r["fp"], r["chain"]) for r in chains.where("chain != fp").collect()}
    have = {frozenset(x % (1 << 64) for x in e) for e in links}
    assert brute_components(sorted(fps), lambda a, b: frozenset((a, b)) in have) == brute_components(
        sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4
    )


def shingles(text, n=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def similar(rows, least=0.8):
    """By brute force: the smallest id of each row's component of links."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingles(t), []).append(i)
    nodes = sorted(sets, key=lambda s: (len(s), sorted(s)))
    where = {}
    for k, s in enumerate(nodes):
        for x in s:
            where.setdefault(x, []).append(k)
    meet = {frozenset((a, b)) for v in where.values() for a in v for b in v if a != b}
    linked = {frozenset(p) for p in map(tuple, meet) if jaccard(nodes[p[0]], nodes[p[1]]) >= least}
    root = brute_components(list(range(len(nodes))), lambda a, b: frozenset((a, b)) in linked)
    ids = {}
    for k, s in enumerate(nodes):
        ids.setdefault(root[k], []).extend(i for i in sets[s] if i is not None)
    return {i: min(ids[root[k]]) for k, s in enumerate(nodes) for i in sets[s] if i is not None}


def test_similar_groups_against_brute_force(spark):
    """Nothing is dropped that no chain of links of 0.8 explains; nine tenths of what has to go goes."""
    df = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    rng = random.Random(4)
    for i in range(150):  # copies with words changed, at all similarities around 0.8
        words = (texts[rng.choice(sorted(texts))] or "").split()
        if len(words) >= 60:
            for _ in range(max(1, round(len(words) * rng.uniform(0.002, 0.03)))):
                words[rng.randrange(len(words))] = f"neu{rng.randrange(10**6)}"
            texts[100_000 + i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = similar(texts.items())
    got = {r["doc_id"]: r["keep_id"] for r in simhash.similar_groups(df).collect()}
    assert got.keys() == want.keys()
    gone = {i for i in want if want[i] != i}
    found = {i for i in got if got[i] != i}
    assert found <= gone and len(found) > 0.9 * len(gone) > 100
    assert {r["doc_id"] for r in simhash.drop_near_copies(df).collect()} == set(texts) - found


def test_a_hot_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 8)
    monkeypatch.setattr(simhash, "WINDOW", 32)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i in range(400) for k in [i * 7 % 200]]
    rows += [(1000 + i, " ".join(f"v{i}-{j}" for j in range(50))) for i in range(100)]
    got = {r["doc_id"]: r["keep_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 400 else i for i, _ in rows}


def test_one_of_each_group_stays(spark):
    df = awkward(spark)
    left = simhash.drop_near_copies(df)
    assert left.columns == df.columns
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    keep = similar(rows)
    # The id 50 has two texts, of which one is its own: it stays.
    assert {r["doc_id"] for r in left.collect()} == {None} | {i for i in keep if keep[i] == i or i == 50}
    assert simhash.drop_near_copies(awkward(spark, empty=True)).count() == 0
