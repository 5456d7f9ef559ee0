"""Near-duplicates, passages, lines and test items against brute force; odd rows."""

from __future__ import annotations

import random
import re
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import sentence
from pyspark.sql import functions as F

from tidemill.llm import components, decontamination, line_runs, passage_chains, superminhash

LOWER = {n: n + 32 for n in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    found = words(text)
    if len(found) >= size:
        return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)}
    return {tuple(found)} if found else set()


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def edited(source, text, share):
    return " ".join(w if source.random() > share else sentence(source, 1) for w in text.split(" "))


@pytest.fixture(scope="module")
def copies():
    """Families of exact and edited copies, with a family of many members and many links in between."""
    source = random.Random(2)
    texts = [sentence(source, source.randint(1, 80)) for _ in range(60)]
    for base in texts[:12]:
        texts += [base, base.upper(), *[edited(source, base, share) for share in (0.02, 0.05, 0.1, 0.2)]]
    large = sentence(source, 60)
    texts += [edited(source, large, 0.06) for _ in range(120)]
    source.shuffle(texts)
    return [(n * 3 + 1, text) for n, text in enumerate(texts)]


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_all_pairs(frame, copies, size):
    sets = {n: shingles(text, size) for n, text in copies}
    groups = Groups()
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            groups.link(a, b)
    found = superminhash.near_duplicates(frame(copies), size=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {
        n: (len(own), groups.root(n)) for n, own in sets.items()
    }
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len({groups.root(n) for n in sets}) < len(sets) - 40


def test_groups_of_odd_rows(frame, odd_rows):
    found = superminhash.near_duplicates(frame(odd_rows), size=2).collect()
    assert len(found) == len(odd_rows)
    assert all(r.kept and r.component_id == r.doc_id for r in found)
    assert sorted(r.n_shingles for r in found if r.doc_id in (1, 2, 3, 6)) == [0, 0, 0, 1]
    kept = superminhash.keep_one(frame(odd_rows))
    assert kept.count() == len(odd_rows) and "score" in kept.columns
    assert superminhash.near_duplicates(frame([])).count() == 0


def test_texts_that_are_nearly_alike_are_compared_in_blocks(frame, monkeypatch):
    source = random.Random(31)
    base = sentence(source, 150).split()
    texts = [" ".join(base)]
    for n in range(400):
        # From 0 to 20 other words: alike enough to the first, to some of the family, or to none.
        other = list(base)
        for at in source.sample(range(len(base)), n % 21):
            other[at] = f"w{n}x{at}"
        texts.append(" ".join(other))
    sets = {n: shingles(text, 2) for n, text in enumerate(texts)}
    groups = Groups()
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            groups.link(a, b)
    assert len({groups.root(n) for n in sets}) > 50
    compared, write = [], superminhash.write_table

    def counted(df, name):
        table = write(df, name)
        if name in ("pairs", "links-found"):
            compared.append(table.count())
        return table

    monkeypatch.setattr(superminhash, "write_table", counted)
    for block in (superminhash.BLOCK_SHINGLES, 2000):
        monkeypatch.setattr(superminhash, "BLOCK_SHINGLES", block)
        compared.clear()
        found = superminhash.near_duplicates(frame(list(enumerate(texts))), size=2).collect()
        assert {r.doc_id: r.component_id for r in found} == {n: groups.root(n) for n in sets}
        assert sum(compared) < 16 * len(texts), "rows of pairs grow with the texts, not with their square"


def test_blocks_cut_by_batches_are_compared_whole():
    source = random.Random(32)
    rows = []
    for key in range(6):
        own = [sentence(source, 30) for _ in range(3)]
        outside = [(key, 0, 0, 0, 100 * key + n, 100 * key + n, own[n]) for n in range(2)]
        rows += outside + [(key, 0, 0, 1, 100 * key + 10 + n, 100 * key + 10, text) for n, text in enumerate([own[0], "", own[2], own[1]])]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = ["key", "theirs", "ours", "side", "id", "component", "text"]
    expected = {(100 * key, 100 * key + 10) for key in range(6)} | {(100 * key + 1, 100 * key + 13) for key in range(6)}
    for step in (1, 4, 5, 6, 100):
        batches = [
            pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[n : n + step]), kinds, strict=True)], names)
            for n in range(0, len(rows), step)
        ]
        found = [
            pair
            for batch in superminhash._linked(2, 80)(iter(batches))
            for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
        ]
        assert len(found) == len(expected) and set(found) == expected


def test_signatures_estimate_without_bias():
    source = np.random.default_rng(4)
    pool = source.integers(0, 2**63, 4000).astype(np.uint64)
    estimates = []
    for k in range(40):
        part = pool[k * 100 : (k + 1) * 100]
        sets = np.concatenate((np.sort(part[:80]), np.sort(part[20:])))
        signature = superminhash.signatures(sets, np.array([0, 80, 160]))
        estimates.append((signature[0] == signature[1]).mean())
    assert abs(np.mean(estimates) - 0.6) < 0.02
    assert np.var(estimates) < 0.6 * 0.4 / superminhash.COMPONENTS
    least = superminhash.signatures(np.arange(1, 4, dtype=np.uint64), np.array([0, 1, 1, 3]))
    assert sorted(least[0] >> 24) == list(range(superminhash.COMPONENTS)), "one element's ranks are a permutation"
    assert (least[1] == 0xFFFFFFFF).all()


def test_components_of_chains_and_stars(spark):
    source = random.Random(1)
    links = [(n, n + 1) for n in range(0, 200)] + [(1000, 1000 + n) for n in range(1, 100)] + [(5, 5), (None, 3), (7, None)]
    links += [(source.randint(2000, 2100), source.randint(2000, 2100)) for _ in range(60)]
    groups = Groups()
    for a, b in links:
        if a is not None and b is not None and a != b:
            groups.link(a, b)
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert {r.id: r.component for r in found} == {x: groups.root(x) for x in groups.up if groups.root(x) != x}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forests_of_bounded_size_keep_what_is_linked(monkeypatch):
    monkeypatch.setattr(components, "FOREST_NODES", 10)
    source = random.Random(3)
    links = [tuple(source.sample(range(k, 400, 4), 2)) for k in range(4) for _ in range(300)]
    batches = [pa.record_batch([pa.array([x for x, _ in links[k : k + 7]]), pa.array([y for _, y in links[k : k + 7]])], ["a", "b"]) for k in range(0, len(links), 7)]
    rows = [(a, b) for batch in components._forest(iter(batches)) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
    assert sum(len(b) for b in components._forest(iter(batches[:1]))) <= 7

    def groups(pairs):
        found = {x: {x} for x in range(400)}
        for a, b in pairs:
            if found[a] is not found[b]:
                found[a] |= found[b]
                for x in found[b]:
                    found[x] = found[a]
        return {frozenset(g) for g in found.values()}

    assert groups(rows) == groups(links)


def test_lines_equal_a_plain_count(frame):
    source = random.Random(6)
    lines = ["", "  ", *[sentence(source, source.randint(1, 4)) for _ in range(12)]]
    rows = [(n, "\n".join(source.choice(lines) for _ in range(source.randint(1, 12)))) for n in range(60)]
    for least in (1, 2, 4):
        seen, expected = set(), {}
        for n, text in rows:
            split = text.split("\n")
            real = [k for k, line in enumerate(split) if words(line)]
            gone = set()
            for k in range(len(real) - least + 1):
                run = tuple(split[p] for p in real[k : k + least])
                if run in seen:
                    gone.update(real[k : k + least])
                seen.add(run)
            expected[n] = len(split), len(gone), "\n".join(x for k, x in enumerate(split) if k not in gone)
        found = line_runs.remove_repeated_lines(frame(rows), min_lines=least).collect()
        assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in found} == expected


@pytest.mark.parametrize(("least", "least_words"), [(1, 9), (3, 1), (2, 14)])
def test_lines_of_maximal_runs_equal_all_pairs_of_places(frame, least, least_words):
    """Every two places with the same line are extended as far as they agree; long runs go at the later place."""
    source = random.Random(16)
    lines = [sentence(source, source.randint(1, 7)) for _ in range(9)]
    texts = ["\n".join(source.choice([*lines, "", " "]) for _ in range(source.randint(1, 25))) for _ in range(30)]
    texts += [texts[3], "\n".join([lines[0]] * 12), texts[5] + "\n" + texts[9]]
    places, split = [], [text.split("\n") for text in texts]
    for n, own in enumerate(split):
        places.append([k for k, line in enumerate(own) if words(line)])
    gone = [set() for _ in texts]
    for b in range(len(texts)):
        for a in range(b + 1):
            for shift in range(-len(places[b]) + 1, len(places[a])):
                if a == b and shift >= 0:
                    continue
                run = []
                for p in range(len(places[b]) + 1):
                    at = p + shift
                    if p < len(places[b]) and 0 <= at < len(places[a]) and split[b][places[b][p]] == split[a][places[a][at]]:
                        run.append(places[b][p])
                        continue
                    if len(run) >= least and sum(len(words(split[b][k])) for k in run) >= least_words:
                        gone[b].update(run)
                    run = []
    expected = {n: (len(gone[n]), "\n".join(x for k, x in enumerate(own) if k not in gone[n])) for n, own in enumerate(split)}
    found = line_runs.remove_repeated_lines(frame(list(enumerate(texts))), min_lines=least, min_words=least_words).collect()
    assert {r.doc_id: (r.n_removed, r.text) for r in found} == expected
    assert 0 < sum(map(len, gone)) < sum(map(len, split))


def test_texts_of_many_lines_are_rebuilt_in_one_pass(frame):
    lines = [f"line {n} of it" for n in range(50_000)]
    rows = [(1, "\n".join(lines[:25_000])), (2, "\n".join(lines))]
    began = time.monotonic()
    found = {r.doc_id: r for r in line_runs.remove_repeated_lines(frame(rows).withColumn("_gone", F.lit(1)), min_words=50).collect()}
    assert time.monotonic() - began < 60
    assert found[1].text == rows[0][1] and found[2].n_removed == 25_000 and found[2]["_gone"] == 1
    assert found[2].text == "\n".join(lines[25_000:])


def test_runs_are_the_longest_powers_of_two(frame):
    rows = [(1, "a\nb\nc\nd\ne\nx"), (2, "q\na\nb\nc\nd\ne"), (3, "c\nd\ny")]
    found = {(r.owner, r.pos): (r.lines, r.source, r.source_pos) for r in line_runs.repeated_runs(frame(rows)).collect()}
    assert found[2, 1] == (4, 1, 0) and found[2, 2] == (4, 1, 1) and found[2, 3] == (2, 1, 2)
    assert found[3, 0] == (2, 1, 2) and found[3, 1] == (1, 1, 3) and len(found) == 7
    with pytest.raises(ValueError):
        line_runs.repeated_runs(frame(rows), min_lines=3)


def test_lines_of_odd_rows(frame, odd_rows):
    cleaned = line_runs.remove_repeated_lines(frame(odd_rows))
    found = cleaned.collect()
    assert len(found) == len(odd_rows) and cleaned.columns[:2] == ["doc_id", "text"] and "score" in cleaned.columns
    same = [r for r in found if r.doc_id == 4 and r.n_removed == 0]
    assert len(same) == 3, "equal rows are one document"
    assert {(r.doc_id, r.n_lines) for r in found if r.doc_id in (1, 2, 3)} == {(1, 0), (2, 1), (3, 2)}
    assert all(r.n_removed == 0 for r in found)
    assert line_runs.remove_repeated_lines(frame([])).count() == 0


@pytest.fixture(scope="module")
def passages():
    """Documents that share exact, edited and shifted passages; some only phrases."""
    source = random.Random(8)
    shared = [sentence(source, source.randint(55, 90)) for _ in range(6)]
    rows, held = [], {}
    for n in range(60):
        parts = [sentence(source, source.randint(0, 60))]
        for k in source.sample(range(6), source.randint(0, 2)):
            held.setdefault(k, []).append(n)
            parts += [edited(source, shared[k], source.choice([0, 0.04])), sentence(source, source.randint(0, 40))]
        rows.append((n, " ".join(p for p in parts if p)))
    rows.append((100, rows[0][1].upper()))
    rows.append((101, sentence(source, 30) + " " + " ".join(shared[0].split()[:12]) + " " + sentence(source, 30)))
    return rows, held


def test_passages_are_found_and_alike(frame, passages):
    rows, held = passages
    texts = {n: words(text) for n, text in rows}
    found = passage_chains.repeated_passages(frame(rows)).collect()
    groups = Groups()
    for r in found:
        a = texts[r.doc_id][r.first_word : r.end_word]
        b = texts[r.source_id][r.source_first : r.source_end]
        assert r.source_id < r.doc_id and min(len(a), len(b)) >= 50 and 0.8 <= r.identity <= 1
        shared, row = 0, [0] * (len(b) + 1)
        for w in a:
            before = row[:]
            for k, v in enumerate(b, 1):
                row[k] = max(before[k], row[k - 1], before[k - 1] + (v == w))
        assert row[-1] >= 0.8 * max(len(a), len(b))
        groups.link(r.doc_id, r.source_id)
    for k, owners in held.items():
        assert len({groups.root(n) for n in owners}) == 1, k
    assert any(r.doc_id == 100 and r.source_id == 0 and r.identity == 1 for r in found)
    assert all(101 not in (r.doc_id, r.source_id) for r in found)


def test_chains_equal_all_subsets():
    source = random.Random(5)
    for _ in range(60):
        n = source.randint(1, 7)
        x, y = (np.array([source.randint(0, 60) for _ in range(n)]) for _ in "xy")
        best = 0.0
        for size in range(1, n + 1):
            for some in combinations(sorted(range(n), key=lambda k: x[k]), size):
                steps = list(zip(some, some[1:], strict=False))
                if all(x[a] < x[b] and y[a] < y[b] for a, b in steps):
                    gaps = sum(x[b] - x[a] + y[b] - y[a] - 2 for a, b in steps)
                    best = max(best, 5 * size - 0.1 * gaps)
        path = passage_chains.chain(x, y)[0]
        gaps = sum(x[b] - x[a] + y[b] - y[a] - 2 for a, b in zip(path, path[1:], strict=False))
        assert abs(5 * len(path) - 0.1 * gaps - best) < 1e-9
        assert sorted(p for c in passage_chains.chain(x, y) for p in c) == list(range(n))


def test_a_family_of_edited_copies_is_one_group(frame):
    source = random.Random(13)
    base = sentence(source, 60)
    rows = [(n, " ".join((sentence(source, 40), edited(source, base, 0.1), sentence(source, 40)))) for n in range(100)]
    groups = Groups()
    for r in passage_chains.repeated_passages(frame(rows)).collect():
        groups.link(r.doc_id, r.source_id)
    assert len({groups.root(n) for n, _ in rows}) == 1


def test_a_passage_of_phrases_that_many_hold_is_found(frame):
    source, rows = random.Random(14), []
    for _ in range(3):
        own = sentence(source, 60).split(" ")
        rows += [" ".join((sentence(source, 30), *own, sentence(source, 30))) for _ in range(2)]
        for k in range(0, 51, 5):
            rows += [" ".join((sentence(source, 25), *own[k : k + 10], sentence(source, 25))) for _ in range(30)]
    found = {(r.doc_id, r.source_id) for r in passage_chains.repeated_passages(frame(list(enumerate(rows)))).collect()}
    assert found == {(1, 0), (333, 332), (665, 664)}


@pytest.fixture(scope="module")
def common_phrase():
    """Documents with one phrase too short for a passage; 10 of them have passages that the phrase is in, two by two."""
    source, rows = random.Random(15), []
    rare = lambda n: " ".join(f"w{source.randrange(10**6)}" for _ in range(n))
    phrase = rare(12)
    for n in range(240):
        if n % 24 == 0:
            own = " ".join((rare(30), phrase, rare(30)))
        around = own if n % 24 in (0, 7) and n < 120 else " ".join((rare(30), phrase, rare(30)))
        rows.append((n, " ".join((rare(20), edited(source, around, 0.04) if n % 24 == 7 else around))))
    return rows


@pytest.mark.parametrize("block", [7, 8192])
def test_a_phrase_of_many_documents_makes_few_pairs(frame, common_phrase, monkeypatch, block):
    handed, points = [], passage_chains._points

    def counted(shared, pairs):
        handed.append(pairs.count())
        return points(shared, pairs)

    monkeypatch.setattr(passage_chains, "_points", counted)
    monkeypatch.setattr(passage_chains, "BLOCK", block, raising=False)
    found = {(r.doc_id, r.source_id) for r in passage_chains.repeated_passages(frame(common_phrase)).collect()}
    assert found == {(n + 7, n) for n in range(0, 120, 24)}
    assert sum(handed) < len(common_phrase), "28,680 pairs hold the phrase"


def test_runs_of_one_word_make_no_pairs(frame, monkeypatch):
    """Texts with one word 38 times share a single seed, which is no chain, however many they are."""
    source, handed, points = random.Random(16), [], passage_chains._points
    rare = lambda n: " ".join(f"w{source.randrange(10**6)}" for _ in range(n))
    rows = [(n, " ".join((rare(30), "of " * 38 + rare(30)))) for n in range(60)]
    shared = rare(60)
    rows += [(100 + n, " ".join((rare(30), shared, rare(30)))) for n in range(2)]

    def counted(shared, pairs):
        handed.append(pairs.count())
        return points(shared, pairs)

    monkeypatch.setattr(passage_chains, "_points", counted)
    found = {(r.doc_id, r.source_id) for r in passage_chains.repeated_passages(frame(rows)).collect()}
    assert found == {(101, 100)}
    assert sum(handed) < len(rows), "1,770 pairs hold the word"


def test_windows_that_may_hold_a_passage_meet():
    """Blocks lose no pair that the numbers of words and pairs of words alike let through."""
    source = np.random.default_rng(3)
    near = [source.integers(0, 40, source.integers(30, 96)).astype(np.uint16) for _ in range(60)]
    near += [np.where(source.random(len(x)) < 0.1, 99, x).astype(np.uint16) for x in near[:20]]
    rows = [(1, n, n, False, True, n % 2, x.tobytes(), one, other) for n, x in enumerate(near) for one, other in ((0, 0), (0, 1), (1, 1)) if n % 2 in (one, other)]
    rows.sort(key=lambda r: r[-2:])
    names = ["seed", "class", "component", "covered", "open", "part", "near", "one", "other"]
    batch = pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
    met = set()
    for b in passage_chains._meeting(20, 8)(iter([batch.slice(0, 50), batch.slice(50, 61), batch.slice(111)])):
        new = list(zip(b["class"].to_pylist(), b["first"].to_pylist(), strict=True))
        met.update(new)
    many = lambda x, y: sum((Counter(x) & Counter(y)).values())
    two = [list(zip(x.tolist(), x[1:].tolist(), strict=False)) for x in near]
    alike = {(b, a) for a, b in combinations(range(len(near)), 2) if many(two[a], two[b]) >= 8 and many(near[a].tolist(), near[b].tolist()) >= 20}
    assert met >= alike and len(alike) >= 20


@pytest.mark.parametrize(("n", "percent"), [(50, 80), (50, 90), (60, 85), (100, 80), (200, 80)])
def test_passages_as_unlike_as_stated_are_found(n, percent):
    source, found = np.random.default_rng(n + percent), 0
    for _ in range(100):
        a, b = source.integers(1, 1 << 63, (2, n + 120)).astype(np.uint64)
        b[60 : 60 + n] = a[60 : 60 + n]
        unlike = 60 + source.choice(n, n * (100 - percent) // 100, replace=False)
        b[unlike] += np.uint64(1)
        seeds, at, first = passage_chains.seeds(np.concatenate((a, b)), np.array([0, len(a), 2 * len(a)]))
        ours, theirs = (dict(zip(seeds[k:m].tolist(), at[k:m].tolist(), strict=True)) for k, m in zip(first, [*first[1:-1], None], strict=False))
        shared = sorted(ours.keys() & theirs.keys(), key=ours.get)
        if len(shared) > 1:
            rows = passage_chains.align(a, b, [ours[h] for h in shared], [theirs[h] for h in shared])
            assert all(min(r[1] - r[0], r[3] - r[2]) >= 50 and 100 * r[4] >= 80 * max(r[1] - r[0], r[3] - r[2]) for r in rows)
            found += any(r[1] - r[0] >= 0.95 * n for r in rows)
    assert found >= 97


def test_passages_of_odd_rows(frame, odd_rows):
    found = passage_chains.repeated_passages(frame(odd_rows)).collect()
    assert [r for r in found if r.doc_id != r.source_id] == []
    long = [(1, "w " * 30_000 + sentence(random.Random(1), 70)), (None, sentence(random.Random(1), 70))]
    (row,) = passage_chains.repeated_passages(frame(long)).collect()
    assert (row.doc_id, row.source_id, row.first_word, row.end_word) == (None, 1, 0, 70)
    assert passage_chains.repeated_passages(frame([])).count() == 0


def aligned(item, region):
    """Best local alignment score by the plain table."""
    best, above = 0, [0] * (len(region) + 1)
    for w in item:
        row = [0]
        for k, v in enumerate(region, 1):
            row.append(max(0, above[k - 1] + (2 if v == w else -1), above[k] - 1, row[-1] - 1))
        above = row
        best = max(best, *row)
    return best


def test_alignment_equals_the_plain_table():
    source = np.random.default_rng(3)
    items = [source.integers(5, 9, source.integers(1, 12)).astype(np.uint64) for _ in range(80)]
    regions = [source.integers(5, 9, source.integers(1, 30)).astype(np.uint64) for _ in range(80)]
    found = decontamination.align(items, regions)
    for item, region, (score, first, end) in zip(items, regions, found, strict=True):
        assert score == aligned(item.tolist(), region.tolist())
        assert score == 0 or aligned(item.tolist(), region[first:end].tolist()) == score


def test_leaks_equal_aligning_everything(spark, frame):
    source = random.Random(12)
    items = [(n, sentence(source, source.randint(8, 40))) for n in range(15)]
    rows = []
    for n in range(80):
        parts = [sentence(source, source.randint(0, 40))]
        for k in source.sample(range(15), source.choice([0, 0, 1, 2])):
            copy = edited(source, items[k][1], source.choice([0, 0.05, 0.15]))
            cut = copy.split(" ")[: source.choice([2, 100, 100])]
            parts += [" ".join(cut).title(), sentence(source, 5)]
        rows.append((n, "\n".join(parts)))
    benchmark = spark.createDataFrame([*items, (50, None), (51, "  "), (None, "x y z"), items[3]], "item_id long, text string")
    expected, surely = {}, set()
    for n, text in rows:
        for k, item in items:
            score = aligned(words(item), words(text)) / (2 * len(words(item)))
            if score >= 0.5:
                expected[n, k] = score
                if shingles(text, 5) & shingles(item, 5):
                    surely.add((n, k))
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.leaks(frame(rows), benchmark).collect()}
    assert found.items() <= expected.items() and surely <= found.keys() and len(surely) > 30
    clean = decontamination.decontaminate(frame(rows), benchmark)
    assert {r.doc_id for r in clean.collect()} == {n for n, _ in rows} - {n for n, _ in found}
    assert clean.columns == frame(rows).columns


def test_leaks_of_odd_rows(spark, frame, odd_rows):
    benchmark = spark.createDataFrame([(1, "same words in this row"), (2, "dan"), (3, "")], "item_id long, text string")
    found = decontamination.leaks(frame(odd_rows), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in found] == [(4, 1, 1.0)] * 2 + [(None, 2, 1.0)] or sorted(
        (r.item_id, r.score) for r in found
    ) == [(1, 1.0), (1, 1.0), (2, 1.0)]
    none = benchmark.where("item_id > 5")
    assert decontamination.leaks(frame(odd_rows), none).count() == 0
    assert decontamination.decontaminate(frame(odd_rows), none).count() == len(odd_rows)
    assert decontamination.leaks(frame([]), benchmark).count() == 0


def test_clean_documents_keep_columns_of_any_name(spark, frame):
    item = "one test item of ten words that nobody else has"
    documents = frame([(1, item), (2, "clean words only"), (None, None)]).selectExpr("*", "1 AS leaks", "2 AS _leaks")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontamination.decontaminate(documents, benchmark)
    assert left.columns == documents.columns
    assert sorted((r.doc_id or 0, r.leaks, r["_leaks"]) for r in left.collect()) == [(0, 1, 2), (2, 1, 2)]
