"""Vector codes, centroids and anchor points against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from llm_texts import sentence

from compare import connect, same_rows
from tidemill.llm import anchor_cover, queries, ragged, sharded_lloyd, vector_codes, vectors

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def integers(rows, scale, length):
    kept = [(n, v) for n, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [(n, [math.floor(scale * float(np.float32(x))) for x in v]) for n, v in kept if len(v) == length]


def lloyd(points, centres, rounds):
    """Codes, distances and final centres with Python's whole numbers."""
    for turn in range(rounds + 1):
        found = []
        for p in points:
            found.append(min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(centres)))
        if turn == rounds:
            return [k for _, k in found], [d for d, _ in found], centres
        moved = []
        for k, c in enumerate(centres):
            own = [p for p, (_, at) in zip(points, found) if at == k]
            moved.append([sum(column) // len(own) for column in zip(*own)] if own else c)
        centres = moved


def odd_vectors(seed, rows=150, length=8):
    source = np.random.default_rng(seed)
    made = [(n, source.normal(size=length).astype(np.float32).tolist(), int(n % 4)) for n in range(3, rows)]
    made += [(n, v, None) for n, v, _ in made[:20]]  # repeated numbers and vectors
    made += [(500 + n, made[5][1], 9) for n in range(60)]  # one vector many times
    made += [(None, made[0][1], 1), (2, None, 1), (1, [], 1), (0, [1.0] * (length - 1), 1)]
    made += [(700, [None] + [1.0] * (length - 1), 1), (701, [math.nan] * length, 1), (702, [math.inf] * length, 1)]
    made += [(800, [1000.0] * length, None), (801, [-1000.5] * length, None), (802, [0.0] * length, None)]
    return made


@pytest.mark.parametrize("shards", [1, 3])
def test_clusters_equal_plain_rounds(spark, shards):
    rows = odd_vectors(5)
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS cluster", "2 AS distance", "'x' AS chunk").repartition(5)
    found = sharded_lloyd.cluster(table, clusters=7, rounds=4, length=8, shards=shards).collect()
    kept = integers(rows, 64, 8)
    draw = sorted((hashlib.sha256(f"1:{n}".encode()).hexdigest(), v) for n, v in kept if n is not None)
    number, distance, centres = lloyd([v for _, v in kept], [v for _, v in draw[:7]], 4)
    total = [sum(d for d, at in zip(distance, number) if at == k) for k in range(7)]
    wanted = [(n, k, d, total[k], sum(distance), centres[k]) for (n, _), k, d in zip(kept, number, distance)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_codes_equal_plain_rounds(spark):
    rows = odd_vectors(6)
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS code", "2 AS error", "'x' AS vector").repartition(5)
    # The vector of the smallest number is not of the length of the others here.
    usable = table.where("vec_id IS NULL OR vec_id > 1")
    coded, books = vector_codes.encode(usable, entries=40, rounds=4)
    kept = [(n, v, label) for n, v, label in rows if n is None or n > 1]
    points = integers(kept, 1024, 8)
    labels = {}
    for n, v, label in kept:
        if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v):
            labels.setdefault((n, tuple(math.floor(1024 * float(np.float32(x))) for x in v)), []).append(label)
    first = {}
    for n, v in points:
        if n is not None:
            first[n] = min(first.get(n, v), v)
    codes, errors = [], []
    for part in range(4):
        cut = slice(2 * part, 2 * part + 2)
        number, distance, centres = lloyd([v[cut] for _, v in points], [first[n][cut] for n in sorted(first)[:40]], 4)
        assert books[part].tolist() == centres
        codes.append(number)
        errors.append(distance)
    wanted = [(n, list(c), sum(e)) for (n, _), c, e in zip(points, zip(*codes), zip(*errors))]
    rows_found = coded.collect()
    assert sorted((r.vec_id, r.codes, r.error) for r in rows_found if r.vec_id is not None) == sorted(w for w in wanted if w[0] is not None)
    for r in rows_found:
        assert r.label_error == sum(o.error for o in rows_found if o.label == r.label)


def test_bounds_never_hide_a_nearer_entry():
    source = np.random.default_rng(3)
    points = source.integers(-50, 50, (3000, 4))
    entries = source.integers(-50, 50, (64, 4))
    entries[10] = entries[3]  # a tie
    listed = 8
    state = vector_codes.assign_all(points, entries, listed)
    skipped = 0
    for _ in range(6):
        moved = entries + source.integers(-2, 3, entries.shape)
        change = vector_codes._above(np.sqrt(((moved - entries) ** 2).sum(1).astype(float)))
        entries = moved
        code, _, near, bounds, outer = state
        before = (code.copy(), near.copy(), bounds.astype(np.float64), outer.astype(np.float64))
        *state, used = vector_codes.assign_bounded(points, entries, change, listed, *before)
        exact = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (state[0] == exact.argmin(1)).all() and (state[1] == exact.min(1)).all()
        assert (state[3] <= np.sqrt(np.take_along_axis(exact, state[2], 1))).all()
        listed = max(2, int(used.max()))
        skipped += int((used >= 0).sum())
    assert skipped > 3000


def test_distances_of_large_components_are_exact():
    source = np.random.default_rng(2)
    points = source.integers(-vectors.LARGEST + 1, vectors.LARGEST, (20, 4))
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in points] for p in points]
    assert vectors.squared_distances(points, points).tolist() == plain
    with pytest.raises(ValueError, match="64 bits"):
        vectors.whole(np.array([1e30]), 64)


def test_no_usable_vector(spark):
    for rows in ([], [(1, None, 1), (None, [1.0] * 8, 1), (2, [math.nan] * 8, 1)]):
        table = spark.createDataFrame(rows, VECTORS)
        assert sharded_lloyd.cluster(table, length=8).count() == 0
        assert vector_codes.encode(table)[0].count() == 0


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_clusters"])
def test_vector_queries_equal_sql(spark, name):
    assert same_rows(queries.QUERIES[name](spark, SMALL), queries.SQL[name], connect(SMALL)) > 0


def plain_print(text, size):
    lowered = (text or "").translate({n: n + 32 for n in range(65, 91)})
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    runs = [words[n : n + size] for n in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, threshold):
    """Least reachable number of each; ``prints`` is a list of (number, fingerprint)."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            same = prints[a][0] is not None and prints[a][0] == prints[b][0]
            if same or (prints[a][1] ^ prints[b][1]).bit_count() <= threshold:
                parent[root(a)] = root(b)
    least = {}
    for a, (n, _) in enumerate(prints):
        if n is not None:
            least[root(a)] = min(least.get(root(a), n), n)
    return [least.get(root(a)) for a in range(len(prints))]


def test_fingerprints_of_documents(spark, frame, odd_rows):
    source = random.Random(4)
    rows = list(odd_rows) + [(20 + n, sentence(source, source.randint(1, 60))) for n in range(80)]
    for n in range(60):  # copies with a word changed, upper case and other blanks
        words = rows[-80 + n][1].split()
        words[source.randrange(len(words))] = "Changed"
        rows.append((200 + n, "\t".join(words).title()))
    found = anchor_cover.near_fingerprints(frame(rows).withColumnRenamed("score", "component_id")).collect()
    prints = [(row[0], plain_print(row[1], 4)) for row in rows]
    wanted = [(n, p, c, c is None or n == c) for (n, p), c in zip(prints, plain_components(prints, 4))]
    assert sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id, r.kept) for r in found), key=repr) == sorted(wanted, key=repr)


def test_a_very_long_text_in_pieces(monkeypatch):
    text = " ".join(sentence(random.Random(9), 5000).split())
    data = np.frombuffer(text.encode(), np.uint8)
    monkeypatch.setattr(anchor_cover, "_UNPACKED", 700)
    hashes, first = anchor_cover.shingle_hashes(np.tile(data, 2), np.array([0, len(data), len(data), 2 * len(data)]), 4)
    assert anchor_cover.fingerprints(hashes, first).tolist() == [plain_print(text, 4), 0, plain_print(text, 4)]
    assert ragged.Words(data, np.array([0, len(data)])).counts().tolist() == [5000]


def test_every_half_has_an_anchor_and_close_ones_share_one():
    source = random.Random(8)
    for distance, radius in ((0, 1), (1, 2), (2, 2), (3, 3), (4, 3)):
        for _ in range(100):
            a = source.getrandbits(32)
            b = a
            for bit in source.sample(range(32), distance):
                b ^= 1 << bit
            _, of_a = anchor_cover.anchors(np.array([a], np.uint64), radius)
            _, of_b = anchor_cover.anchors(np.array([b], np.uint64), radius)
            assert set(of_a.tolist()) & set(of_b.tolist())
            assert len(set(of_a.tolist())) == len(of_a)
            assert all((a ^ x).bit_count() <= radius for x in of_a.tolist())


def families(seed, families=6, size=60, flips=4):
    """Numbers in chains and balls around some centres, and numbers at exactly 4 and 5 bits."""
    source = random.Random(seed)
    found = set()
    for _ in range(families):
        at = centre = source.getrandbits(64)
        for n in range(size):
            base = at if n % 2 else centre
            new = base
            for bit in source.sample(range(64), source.randint(1, flips)):
                new ^= 1 << bit
            found.add(new)
            if n % 2:
                at = new
    for distance in (4, 5):
        for _ in range(40):
            a = b = source.getrandbits(64)
            for bit in source.sample(range(64), distance):
                b ^= 1 << bit
            found |= {a, b}
    return sorted(found)


@pytest.mark.parametrize("anchor_rows", [anchor_cover.ANCHOR_ROWS, 3])
def test_links_lose_no_component(spark, anchor_rows):
    values = families(1)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = anchor_cover.links(spark.createDataFrame(signed, "fingerprint long"), anchor_rows=anchor_rows).collect()
    joined = plain_components([(v, v) for v in values], 4)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        a, b = sorted((root(a % (1 << 64)), root(b % (1 << 64))))
        parent[b] = a
    assert [root(v) for v in values] == joined


def test_a_dense_family_is_compared_with_few(monkeypatch):
    source = np.random.default_rng(1)
    values = np.unique(np.uint64(1) << source.integers(0, 64, 4000).astype(np.uint64))
    values = np.unique(values[:, None] | values[None, :])
    assert len(set(anchor_cover.linked(values, 4).tolist())) == 1


def test_no_document(spark, frame):
    assert anchor_cover.near_fingerprints(frame([])).count() == 0
