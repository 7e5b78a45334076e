"""The methods themselves against plain versions: exhaustive near-dedup, k-d tree, packer; odd inputs."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_llm import docs_of, prose

from caseloom.llm import bpe, licenses, minhash, packing, quality, sharding, urls


def exhaustive_classes(rows):
    """Classes by every pair that shares a shingle; nothing of the operator is used."""
    bags, words_of = [], []
    for _, text in rows:
        words = (text or "").lower().split()
        words_of.append(words)
        bags.append(Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = {}
    for k, bag in enumerate(bags):
        shared = Counter()
        for shingle, n in bag.items():
            for other, m in held.setdefault(shingle, []):
                shared[other] += min(n, m)
            held[shingle].append((k, n))
        near = [o for o, x in shared.items() if x * 10 >= 8 * (bag.total() + bags[o].total() - x)]
        near += [o for o in range(k) if not words_of[k] and not words_of[o]]
        for o in near:
            a, b = find(k), find(o)
            root[max(a, b)] = min(a, b)
    best = {}
    for k, (i, _) in enumerate(rows):
        best[find(k)] = min(best.get(find(k), i), i)
    return {i: best[find(k)] for k, (i, _) in enumerate(rows)}


def test_near_classes_equal_an_exhaustive_comparison(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = exhaustive_classes([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs).collect()}
    assert got == want


def test_near_with_ids_of_other_types(spark):
    rng = random.Random(21)
    text = prose(rng, 60)
    rows = [("b", text), ("a", text + " tail"), (None, text.upper()), ("z", prose(rng, 60)), ("y", prose(rng, 60)), ("y", text)]
    got = minhash.near_classes(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id or "", r.class_id or "", r.kept) for r in got) == [("", "", True), ("a", "", False), ("b", "", False), ("y", "", False), ("y", "", False), ("z", "z", True)]


# ------------------------------------------------------------------- k-d tree
def plain_tree(points, rooms, n_dims, at=0):
    """{tie: leaf} by sorting each node's points; points are (coordinates, tie, weight)."""
    if len(rooms) == 1:
        return {tie: at for _, tie, _ in points}
    spread = [max((p[0][i] for p in points), default=-1) - min((p[0][i] for p in points), default=0) for i in range(n_dims)]
    wide = spread.index(max(spread))
    key = lambda p: (p[0][wide], p[1])
    mid = len(rooms) // 2
    goal, running, left = sum(p[2] for p in points) * sum(rooms[:mid]) / sum(rooms), 0, []
    ordered = sorted(points, key=key)
    for p in ordered:
        if running + p[2] >= goal:
            break
        running += p[2]
        left.append(p)
    right = ordered[len(left) :]
    return plain_tree(left, rooms[:mid], n_dims, at) | plain_tree(right, rooms[mid:], n_dims, at + mid)


@pytest.mark.parametrize("rooms", [[1.0] * 8, [3.0, 1.0, 2.0, 2.0, 1.0]])
def test_kd_tree_cuts_at_weighted_medians(spark, rooms):
    rng = random.Random(22)
    points = [((rng.randrange(40), rng.randrange(1024)), tie, rng.randint(1, 90)) for tie in rng.sample(range(sharding._TIE), 300)]
    rows = spark.createDataFrame([(*at, tie, w) for at, tie, w in points], "d0 int, d1 int, tie long, weight long")
    got = {r.tie: r.shard for r in sharding._tree(rows, 2, rooms).collect()}
    assert got == plain_tree(points, rooms, 2)


def test_shards_by_target_and_written(spark, tmp_path):
    rng = random.Random(23)
    rows = [(i % 400, prose(rng, rng.randint(1, 40))) for i in range(500)] + [(None, None), (None, ""), (7, "same"), (7, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    assert sharding.kd_shards(docs, None, target_bytes=total // 5).select("shard").distinct().count() == 6
    sharding.write_shards(docs, str(tmp_path / "s"), n_shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)
    want = {(r.doc_id, r.text_crc32): r.shard for r in sharding.kd_shards(docs, 4).collect()}
    assert all(want[r.doc_id, zlib.crc32((r.text or "").encode())] == r.shard for r in back.collect())


# -------------------------------------------------------------------- packing
def test_packer_takes_the_largest_dot_product():
    """Every choice replayed: the fitting rest with the largest product, or a cut of the largest when none fits."""
    rng = random.Random(24)
    limits = packing.Limits(tokens=1000, segments=6, loss=500, sliver=8)
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    sizes = rng.sample(range(20, 990), 200)
    examples = {k: (n, rng.randrange(max(0, n - 480), n + 1)) for k, n in enumerate(sizes)}
    packer = packing.Packer(limits, pool=512)
    pieces = [x for n, loss in examples.values() for x in packer.add(n, loss)] + list(packer.finish())
    loss_of = lambda k, s, e: max(0, e - max(s, examples[k][1]))
    waiting = {k: (0, n) for k, (n, _) in examples.items()}
    for seq in range(max(p[3] for p in pieces) + 1):
        left, live, at = cap.copy(), set(waiting), 0
        for k, s, n, _, offset in (p for p in pieces if p[3] == seq):
            need = {j: np.array([waiting[j][1] - waiting[j][0], 1, loss_of(j, *waiting[j])]) for j in live}
            score = {j: float(need[j] @ (left / cap / cap)) for j in live}
            fits = [j for j in live if (need[j] <= left).all()]
            best = max(fits or live, key=lambda j: score[j])
            assert score[k] == pytest.approx(score[best]) and offset == at and s == waiting[k][0]
            live.discard(k)
            if fits:
                assert s + n == waiting.pop(k)[1]
            else:
                assert left[0] >= limits.sliver
                waiting[k] = (s + n, waiting[k][1])
            left -= (n, 1, loss_of(k, s, s + n))
            at += n
        assert (left >= 0).all()
        assert not [j for j in live if left[1] >= 1 and waiting[j][1] - waiting[j][0] <= left[0] and loss_of(j, *waiting[j]) <= left[2]]
    assert not waiting


# ------------------------------------------------------------------------ bpe
def test_bpe_cache_is_bounded_inside_a_text(monkeypatch):
    rng = random.Random(25)
    coder = bpe.Bpe(P.path(bpe.RANKS), cached=1000)
    text = prose(rng, 9000)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    whole = coder.encode(text)
    assert len(coder.cache) <= 1000 and len(coder.cache.old) <= 1000
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert coder.encode(text) == whole == np.array(ref.encode_ordinary(text), "<u4").tobytes()


# ------------------------------------------------------------------- licences
def test_licenses_inside_other_text(spark):
    rng = random.Random(26)
    texts = dict(licenses.TEMPLATES[len(licenses.NOTICES) :])
    rows = [(1, "Some prose here. Licensed under the MIT License. More prose"), (2, "Copyright (c) 2021 Foo Inc. All rights reserved."), (3, " ".join(texts["MIT"].split()))]
    names = sorted(texts)
    hurt = []
    for name in names:  # one word in fifty replaced, between prose, on one line
        words = texts[name].split()
        for k in rng.sample(range(len(words)), len(words) // 50):
            words[k] = prose(rng, 1)
        hurt.append((10 + len(hurt), f"{prose(rng, 90)} {' '.join(words)} {prose(rng, 90)}"))
    got = {r.doc_id: [m.license for m in r.matches] for r in licenses.scan_licenses(docs_of(spark, rows + hurt)).collect()}
    assert got[1] == ["MIT"] and got[2] == ["All-rights-reserved"] and got[3] == ["MIT"]
    found = [name in got[i] for (i, _), name in zip(hurt, names)]
    assert np.mean(found) >= 0.9
    assert all("BSD-3-Clause" not in got[i] for (i, _), name in zip(hurt, names) if name == "BSD-2-Clause")


# ----------------------------------------------------------------------- urls
def test_urls_with_long_hosts_and_tables(spark):
    host = "a." * 200_000 + "net"
    assert [len(h) for h, _ in urls.candidates(host, "/x", [1], [1, 2, 3])] == [3, 5, 7]
    pages = spark.createDataFrame([(1, f"http://{host}/x"), (2, "http://EXAMPLE.net/en/a"), (2, "http://EXAMPLE.net/en/a"), (3, None)], "page_id long, url string")
    as_table = lambda rules: spark.createDataFrame(list(rules), "host string, path string, verdict string")
    one = urls.judge_urls(pages).collect()
    assert one == urls.judge_urls(pages, as_table(urls.RULES), as_table(urls.LISTED)).collect() and len(one) == 4
    assert [r.verdict for r in sorted(one, key=lambda r: r.page_id)] == ["block", "allow", "allow", "allow"]


# -------------------------------------------------------------------- quality
def test_quality_spares_markdown_and_unspaced_scripts(spark):
    rng = random.Random(27)
    listed = "\n".join(f"* {prose(rng, 3)}" for _ in range(40))
    tabled = "\n".join(f"| {prose(rng, 2)} | {prose(rng, 2)} |" for _ in range(40))
    han = " ".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(40)) for _ in range(60))
    junk = " ".join("#" * 3 + prose(rng, 1) for _ in range(80))
    long = " ".join("".join(rng.choice("abcdef") for _ in range(40)) for _ in range(60))
    kept = quality.keep_good(docs_of(spark, [(1, listed), (2, tabled), (3, han), (4, junk), (5, long)]))
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3}


# ------------------------------------------------------------------- pipeline
def test_pipeline_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(28)
    text = prose(rng, 80)
    odd = docs_of(spark, [(1, text), (1, text), (None, text.upper()), (2, text + " tail"), (3, None), (4, ""), (5, prose(rng, 3000))])
    odd.write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    odd.limit(0).write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "odd")).toPandas()
    assert set(out.doc_id) == {1, 5}
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
