import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from samples import awkward, clashing, groups, words

from opsflow.llm import components, line_dedup, simhash, vectors
from opsflow.session import job_scope

BLANKS = " \t\n\x0b\x0c\r"


def lines_by_hand(texts, min_docs, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))

    split = [(t or "").split("\n") for t in texts]
    held = {}
    for own in split:
        for k in {key(line) for line in own}:
            held[k] = held.get(k, 0) + 1
    gone = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(own), sum(key(x) in gone for x in own), "\n".join(x for x in own if key(x) not in gone)) for own in split]


def test_lines_of_awkward_rows(spark):
    more = [(100 + i, f"Shared LINE\nown {i}\n\tshared line \n\n\nÉté", "en", "a", 1) for i in range(4)]
    docs = clashing(awkward(spark, more))
    with job_scope(spark):
        got = line_dedup.dedup_lines(docs, min_docs=3)
        assert got.columns[:-1] == docs.columns and got.columns[-1] == "lines_"
        found = sorted(((str(r.doc_id), r.lines_.n_lines, r.lines_.n_dropped, r.lines_.kept) for r in got.collect()))
        rows = docs.collect()
        wanted = sorted((str(r.doc_id), *own) for r, own in zip(rows, lines_by_hand([r.text for r in rows], 3)))
        assert found == wanted and any(w[2] == 3 for w in wanted)
        kept = line_dedup.without_lines(docs, min_docs=3)
        assert kept.columns == docs.columns and kept.count() == len(rows)
        assert kept.where("doc_id = 2 and text is not null").count() == 0
        assert kept.where("length(text) <> n_chars").count() == 0
        assert line_dedup.without_lines(docs.where("false")).collect() == []


def test_runs_take_batches_one_by_one(spark):
    batches = [["a\nb", "b\nc"], ["b", "d\na"], [], ["a", "c\na", "e"], ["c", "f\nf\nf"]]
    with job_scope(spark):
        runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
        for batch in batches:
            runs.add(line_dedup.batch_counts(spark.createDataFrame([(t,) for t in batch], "text string")))
            assert all(len(level) < 2 for level in runs.levels)
        found = {(r.key_a, r.key_b) for r in runs.frequent().collect()}
        keys = spark.createDataFrame([(k,) for k in "abcdef"], "key string").select("key", *line_dedup._hashes("key"))
        assert {r.key for r in keys.collect() if (r.key_a, r.key_b) in found} == set("abc")


def by_hand(text, n=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = words(lowered)
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + n]).encode(), 42) for i in range(max(1, len(own) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "É", " ", "x-y", "İ", "1"]), max_size=12), st.sampled_from([" ", "\n", "\t ", "\x0b"]))
def test_fingerprint(parts, gap):
    text = gap.join(parts)
    assert simhash.fingerprint(text, 4) == by_hand(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 101}" for i in range(500))
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 64)
    assert simhash.fingerprint(text, 4) == by_hand(text)


def test_simhash_of_awkward_rows(spark):
    base = " ".join(f"term{i}" for i in range(300))
    more = [(50 + i, base + f" tail{i}", "en", "a", 1) for i in range(6)] + [(49, base, "en", "z", 1)]
    docs = clashing(awkward(spark, more))
    with job_scope(spark):
        rows = docs.collect()
        prints = {(r.doc_id, r.text): by_hand(r.text) for r in rows}
        nodes = sorted(set(prints.values()))
        near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4]
        root = groups(near, nodes)
        ids = {}
        for (doc_id, _), p in prints.items():
            ids.setdefault(root[p], []).append(doc_id)
        first = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
        wanted = sorted(str((r.doc_id, by_hand(r.text), first[root[by_hand(r.text)]])) for r in rows)
        got = simhash.classes(docs).collect()
        assert sorted(str((r.id, r.fingerprint % 2**64, r.first.id)) for r in got) == wanted
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns and kept.count() == len(ids)
        assert simhash.one_of_each(docs.where("false")).collect() == []


def test_tiles_find_every_close_pair(spark):
    random = np.random.default_rng(5)
    values = random.integers(0, 2**63, 300, dtype=np.uint64)
    near = values[:200] ^ (np.uint64(1) << random.integers(0, 64, 200, dtype=np.uint64))
    far = near ^ (np.uint64(7) << random.integers(0, 60, 200, dtype=np.uint64))
    hot = values[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))  # a large group
    every = np.unique(np.concatenate([values, near, far, hot]))
    pairs = [(int(a), int(b)) for i, a in enumerate(every) for b in every[i + 1 :] if int(a ^ b).bit_count() <= 4]
    root = groups(pairs, [int(v) for v in every])
    with job_scope(spark):
        distinct = spark.createDataFrame([(int(v),) for v in every.view(np.int64)], "fingerprint long")
        for tile in (16, 4096):
            found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(distinct, 4, tile).collect()]
            assert all((a ^ b).bit_count() <= 64 for a, b in found)
            assert groups(found, [int(v) for v in every]) == root


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    with job_scope(spark):
        got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = groups(pairs, {n for p in pairs for n in p})
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: wanted[n] for n in linked}


def test_components_of_a_long_chain(spark):
    with job_scope(spark):
        chain = spark.range(200).selectExpr("id as a", "id + 1 as b")
        assert {r.component for r in components.components(chain).collect()} == {0}


def vectors_by_hand(rows, threshold=0.95):
    def cosine(a, b):
        a, b = (np.array(x, float) / np.abs(x).max() for x in (a, b))
        return a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)

    fine = [(i, v) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    pairs = [(a, b) for n, (a, v) in enumerate(fine) for b, w in fine[n + 1 :] if len(v) == len(w) and cosine(v, w) >= threshold]
    root = groups(pairs, [i for i, _ in rows if i is not None])
    return sorted((i, sum(i in p for p in pairs), root[i]) for i, _ in rows if i is not None)


def test_vectors(spark, monkeypatch):
    random = np.random.default_rng(4)
    centre = random.standard_normal(16)
    rows = [(i, random.standard_normal(16).tolist()) for i in range(60)]
    rows += [(100 + i, (centre + 0.05 * random.standard_normal(16)).tolist()) for i in range(80)]  # a large group
    rows += [(200 + i, (centre * (i + 1)).tolist()) for i in range(3)] + [(210 + i, rows[0][1]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 16), (302, [1.0, None] * 8), (303, [float("nan")] * 16), (304, [float("inf")] * 16),
             (305, [1.0, 2.0]), (306, [1.0, 2.0]), (307, []), (308, [1e200, 2e200]), (309, [1e-200, 2e-200])]
    monkeypatch.setattr(vectors, "TILE", 16)
    with job_scope(spark):
        for kind in ("double", "float"):
            own = [r for r in rows if kind == "double" or r[0] < 308]
            df = clashing(spark.createDataFrame(own, f"vec_id long, embedding array<{kind}>"))
            got = vectors.near_duplicates(df).collect()
            assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == vectors_by_hand(own)
            assert all(r.kept == (r.vec_id == r.component_id) for r in got)
        empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
        assert vectors.near_duplicates(empty).collect() == []
        lost = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
        assert sorted((r.vec_id or 0, r.n_links) for r in vectors.near_duplicates(lost).collect()) == [(0, 0), (1, 0)]


def test_vectors_of_one_id_are_linked_each_by_its_own(spark):
    random = np.random.default_rng(14)
    a, b, c = (random.standard_normal(16) for _ in range(3))
    rows = [(1, a), (1, b), (2, a * 2), (3, b * 2), (4, b * 3), (9, b), (5, c), (6, c * 2), (1, c * 3)]
    with job_scope(spark):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (1, 3, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1), (5, 2, 1), (6, 2, 1), (9, 3, 1)]


def test_pairs_at_the_threshold_are_found_and_none_below(spark):
    """Pairs planted just above and just below cosine 0.95, far from each other; the hashing misses 0.3 % of the first."""
    random = np.random.default_rng(95)
    rows, above = [], 600
    for pair in range(2 * above):
        cosine = 0.9501 if pair < above else 0.9499
        axis, other = np.linalg.qr(random.standard_normal((64, 2)))[0].T
        near = cosine * axis + np.sqrt(1 - cosine**2) * other
        rows += [(2 * pair, (axis * 3).tolist()), (2 * pair + 1, (near * 0.01).tolist())]
    with job_scope(spark):
        got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), threshold=0.95).collect()
    assert len(got) == 4 * above
    assert all(r.n_links == 0 and r.kept for r in got if r.vec_id >= 2 * above)
    found = [r for r in got if r.vec_id < 2 * above and r.n_links]
    assert all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in found)
    assert len(found) / (2 * above) >= 0.985
