"""Small cases and brute-force comparisons of the training-data operators."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseloom.llm import bpe, chat, exact_dedup, licenses, line_dedup, minhash, packing, quality, registry, sharding, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, extra=True):
    """(doc_id, text) rows as documents, with extra columns whose names could clash."""
    df = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS)
    if extra:
        for name in ("digest", "group", "size", "words", "ids", "pos", "key", "shard", "body", "row_id"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "x"), (None, "x"), (4, "Same Text"), (5, "same text"), (5, "same text"), (6, "SAME TEXT"), (7, "É"), (2**60 + 1, "é"), (9, "a\n\nb\n"), (10, "word " * 5000)]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [(1, "x")]).limit(0)


# ---------------------------------------------------------------- exact dedup
def brute_exact(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(fold), []).append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(odd, weak):
    how = {"digest": lambda t: F.substring(F.sha2(t, 256), 1, 1), "exact_digest": False} if weak else {}
    got = exact_dedup.exact_dedup(odd, **how).collect()
    want = brute_exact(ODD)
    assert len(got) == len(ODD)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in got)
    assert sum(r.kept for r in got) == len(want)
    assert not [r for r in got if r.kept and r.doc_id != r.keep_id]


def test_drop_copies(odd, empty):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(brute_exact(ODD))
    assert exact_dedup.drop_copies(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0


# ------------------------------------------------------------------- sharding
def test_shards(spark, odd, empty):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 60)) if i % 5 else "copied text " * 3) for i in range(2000)] + [(9000 + i, "hot " * 40) for i in range(900)]
    out = sharding.kd_shards(docs_of(spark, rows)).toPandas()
    assert sorted(out.doc_id) == sorted(i for i, _ in rows)
    for _, some in out.groupby("shard"):
        assert sorted(some.slot) == list(range(len(some)))
    load = out.groupby("shard")["size"].sum()
    assert len(load) == 16 and load.max() < 1.1 * load.mean() and load.min() > 0.9 * load.mean()
    text = dict(rows)
    assert all(s == len(text[i].encode()) + 1 and c == zlib.crc32(text[i].encode()) for i, s, c in zip(out.doc_id, out["size"], out.text_crc32))
    whole = out[out.doc_id < 9000].groupby(out.doc_id.map(text))["shard"].nunique()
    assert whole.max() == 1  # only the group larger than a shard is cut
    assert sharding.kd_shards(odd).count() == len(ODD)
    assert sharding.kd_shards(empty).count() == 0


# ------------------------------------------------------------------- quality
def brute_repeat(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hot = {g for g in grams if grams.count(g) > 1}
    return len({i + k for i, g in enumerate(grams) if g in hot for k in range(3)})


def test_quality_figures(spark, odd, empty):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randint(0, 90)))) for i in range(60)]
    rows += [(100, "a b c d\n" * 40), (101, " ".join(f"w{i} x y z" for i in range(60)) * 2), (102, "x" * 100000)]
    out = {r.doc_id: r for r in quality.quality_report(docs_of(spark, rows)).collect()}
    for i, t in rows:
        words = t.split()
        assert (out[i].n_words, out[i].word_chars, out[i].n_repeat_words) == (len(words), sum(map(len, words)), brute_repeat(words))
        lines = [x for x in t.split("\n") if x.strip()]
        assert out[i].n_dup_lines == len(lines) - len(set(lines))
        assert out[i].base_failed == (len(words) < 50 or 100 * out[i].n_repeat_words > 50 * len(words))
    assert quality.quality_report(odd).count() == len(ODD)
    assert quality.quality_report(empty).count() == 0
    assert quality.keep_good(empty).columns == empty.columns


def test_quality_order_changes_nothing(spark):
    rng = random.Random(6)
    rows = [(1, prose(rng, 80)), (2, prose(rng, 80).upper()), (3, prose(rng, 80).replace(" ", "!! ")), (4, "### " * 80), (5, "12345 " * 60 + prose(rng, 9)), (6, "few")]
    docs = docs_of(spark, rows)
    good = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert good == {1}
    body = F.col("text")
    for order in (list(quality.BASE_RULES + quality.RULES), list(quality.BASE_RULES + quality.RULES)[::-1]):
        assert {r.doc_id for r in docs.filter(quality.verdict(body, order).isNull()).collect()} == good


# ----------------------------------------------------------------------- chat
def test_chat_events(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "par"), (1, 1, 3, "delta", None, "tial"),
        (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "fin"), (1, 1, 6, "delta", None, "al"), (1, 0, 7, "edit", None, "hello"),
        (1, 2, 8, "message", "user", "drop me"), (1, 2, 9, "delete", None, None), (2, 0, 0, None, None, None), (None, 0, 0, "message", "user", "a\nb"),
    ]
    events = spark.createDataFrame(random.Random(1).sample(log, len(log)), "conv_id long, message long, seq long, kind string, role string, text string")
    got = {}
    for r in chat.final_messages(events).orderBy("conv_id", "message", "seq").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {1: [("user", "hello"), ("assistant", "final")], 2: [(None, "")], None: [("user", "a\nb")]}
    read = {r.conv_id: r for r in chat.read_back(chat.render(chat.final_messages(events))).collect()}
    assert read[1].turns_sha256 == hashlib.sha256(b"user\nhello\nassistant\nfinal\n").hexdigest()
    assert (read[1].loss_chars, read[1].loss_sha256) == (5, hashlib.sha256(b"final").hexdigest())
    assert chat.format_conversations(events.limit(0)).count() == 0


def test_chat_escapes():
    rng = random.Random(2)
    parts = ["</s>", "[INST]", "[/INST]", "<|im_end|>", "<|x|>", "\\", "\\\\", "<", "/s>", "[IN", "ST]", "n", "\n", "a", "<<SYS>>", "<unk>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert chat.unescape(chat.escape(text)) == text
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
        assert not [c for c in ("</s>", "[INST]", "[/INST]", "<|im_end|>", "<|x|>", "<<SYS>>") if c in chat.escape(text)]


# ------------------------------------------------------------------------ bpe
def test_bpe(spark, odd, empty):
    path = P.path(bpe.RANKS)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rng = random.Random(4)
    texts = ["", "aaaaaaaaaaaaa", "abab" * 2000, " \n\n x  ", "🙂🙂é日本語", "a" * 20000, "<|endoftext|>"]
    texts += ["".join(rng.choice("abcé 日\n'stXYZ01") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    out = bpe.decode(bpe.encode(docs_of(spark, list(enumerate(texts))))).collect()
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == ref.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert bpe.encode(odd).count() == len(ODD) and bpe.decode(bpe.encode(empty)).count() == 0


# ------------------------------------------------------------------ line dedup
def brute_lines(rows, min_docs=3, min_chars=20):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(fold)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(i)
    hot = {k: max(v) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    return {i: "\n".join(x for x in (t or "").split("\n") if hot.get(key(x), i) == i) for i, t in rows}


def test_line_dedup(spark, odd, empty):
    rng = random.Random(7)
    common = [f"a line number {k} that many hold" for k in range(6)] + ["short line"]
    rows = [(i, "\n".join(rng.choice(common + ["  " + common[0].upper() + "\t", prose(rng, 8), ""]) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    for parts in (1, 7, 40):  # runs that end inside, at and across partitions
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = {r.doc_id: r for r in line_dedup.dedup_lines(docs_of(spark, rows)).collect()}
        assert {i: r.kept_text for i, r in out.items()} == brute_lines(rows)
        assert all(r.n_lines - r.n_dropped == (len(r.kept_text.split("\n")) if r.n_dropped < r.n_lines else 0) for r in out.values())
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert line_dedup.dedup_lines(odd).count() == len(ODD)
    assert line_dedup.dedup_lines(empty).count() == 0


# -------------------------------------------------------------------- packing
def check_pieces(out, want, limits):
    for i, some in out.groupby("doc_id"):
        at = 0
        for r in some.sort_values("start").itertuples():
            assert r.start == at and bytes(r.ids) == want[i][4 * at : 4 * (at + r.length)]
            at += r.length
        assert at == len(want[i]) // 4
    for _, some in out.groupby("sequence_id"):
        some = some.sort_values("offset")
        assert some.offset.tolist() == [0, *some.length.cumsum().tolist()[:-1]]
        assert some.length.sum() <= limits.tokens and len(some) <= limits.segments


def test_packing_words_match_library(spark, odd, empty):
    tok = Tokenizer.from_file(P.path(packing.TOKENIZER))
    tok.encode_special_tokens = True
    rng = random.Random(8)
    texts = ["Don't STOP!! it's we've 3 km² ﬁ Straße İstanbul ΣΑΣ", "a\u00a0b\u2003c\x1cd\x85e", "e\u0301e\u0301 H\u0331 word,. word,", "<|endoftext|> x", ""]
    texts += ["".join(rng.choice("abC é.,'st1 \n\t日ß!") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    got = {r.doc_id: bytes(r.ids) for r in packing.tokenize(docs_of(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(got[i], "<u4").tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1]
    assert packing.pack_documents(odd.dropDuplicates(["doc_id"])).select("doc_id").distinct().count() == 11
    assert packing.pack_documents(empty).count() == 0


def test_packing_limits(spark):
    rng = random.Random(9)
    limits = packing.Limits(tokens=64, segments=4, loss=40)
    want = {i: np.arange(n, dtype="<u4").tobytes() for i, n in enumerate([rng.randint(1, 200) for _ in range(400)])}
    loss = {i: rng.choice([0, len(v) // 8, len(v) // 4]) for i, v in want.items()}
    rows = spark.createDataFrame([(i, bytearray(v), loss[i]) for i, v in want.items()], "doc_id long, ids binary, loss long")
    out = packing.pack(rows, loss_col="loss", limits=limits, pool=32).toPandas()
    check_pieces(out, want, limits)
    out["bear"] = [max(0, s + n - max(s, loss[i])) for i, s, n in zip(out.doc_id, out.start, out.length)]
    assert out.groupby("sequence_id").bear.sum().max() <= 40
    whole = packing.pack(rows, limits=packing.Limits(tokens=64)).toPandas()
    check_pieces(whole, want, packing.Limits(tokens=64))
    assert whole.length.sum() / (64 * whole.sequence_id.nunique()) > 0.93


# ------------------------------------------------------------------- licences
def test_licenses(spark, odd, empty):
    text = "Some words here.\nLicensed under the apache license version 2.0!\nmore\n\nPermission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the\nSoftware without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,\nsublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nend"
    got = {r.doc_id: [(m.word, m.license) for m in r.matches] for r in licenses.scan_licenses(docs_of(spark, [(1, text), (2, "the license of a poem is free"), (3, "All rights reserved.")])).collect()}
    assert got == {1: [(3, "Apache-2.0"), (12, "MIT")], 2: [], 3: [(0, "All-rights-reserved")]}
    assert licenses.scan_licenses(odd).count() == len(ODD) and licenses.scan_licenses(empty).count() == 0


# ----------------------------------------------------------------------- urls
URLS = [None, "", "no scheme", "http://NET/", "https://a.b.net?x", "http://example.net/en/x", "http://www.example.net/en", "http://x.example.com/de/1#t", "http://example.com/DE/", "http://notnet/", "http://k.org/fr/a?b", "http://spam-farm.example.com/q", "http://spam-farm.example.net/en/q", "a://b://net/", "http://user@net:80/", "http://.net/x"]


def brute_url(url):
    host, path = urls.split_url(url)
    fits = lambda some: max(((len(h + p), len(h), h + p, v) for h, p, v in some if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    a, b = fits(urls.RULES), fits(urls.LISTED)
    return host, path, a and a[2], (a or b or (0, 0, "", "allow"))[3], b and b[2]


@pytest.mark.parametrize("limit", [urls.MAX_INDEX_BYTES, 0])
def test_urls(spark, limit, monkeypatch):
    monkeypatch.setattr(urls, "MAX_INDEX_BYTES", limit)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.listed) for r in urls.judge_urls(pages).collect()}
    assert got == {i: brute_url(u) for i, u in enumerate(URLS)}
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_collisions():
    rules = [(f"h{i}", "/", "block" if i % 2 else "allow") for i in range(200)]
    weak = lambda s: len(s) % 3
    index = urls.DigestIndex(urls.build_index(rules, weak), weak)
    assert index.judge([(f"x.h{i}", "/a") for i in range(210)]) == [(f"h{i}/", "block" if i % 2 else "allow") if i < 200 else None for i in range(210)]


# -------------------------------------------------------------------- minhash
def brute_near(rows, share=(8, 10)):
    sh = minhash.Shingler(5)
    bags = [sh.bag(sh.words(t)) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = dict(zip(*map(list, bags[a]))), dict(zip(*map(list, bags[b])))
            inter = sum(min(c, y.get(h, 0)) for h, c in x.items())
            union = sum(x.values()) + sum(y.values()) - inter
            if (not union) or inter * share[1] >= union * share[0]:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    best = {}
    for k, (i, _) in enumerate(rows):
        best[find(k)] = min(best.get(find(k), i), i)
    return {i: best[find(k)] for k, (i, _) in enumerate(rows)}


def near_rows():
    rng = random.Random(11)
    rows, families = [], [prose(rng, 120) for _ in range(4)]
    for i in range(90):
        words = rng.choice(families).split()
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = prose(rng, 1)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, prose(rng, rng.randint(1, 60))) for i in range(20)]
    rows += [(300, ""), (301, None), (302, "a b"), (303, "A  b"), (304, "spam " * 400), (305, "spam " * 390), (306, "spam " * 200)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"component_rows": 6}, {"component_rows": 6, "block_rows": 6, "leaders": 2}])
def test_near_classes(spark, limits):
    rows = near_rows()
    got = {r.doc_id: r for r in minhash.near_classes(docs_of(spark, rows), p=minhash.Params(**limits)).collect()}
    assert {i: r.class_id for i, r in got.items()} == brute_near(rows)
    assert all(r.kept == (i == r.class_id) for i, r in got.items())


def test_leader_rounds_with_overlapping_blocks(spark):
    """x leads in one block and y in another; only a third, which strangers may lead first, holds both."""
    rng = random.Random(13)
    rows, want = [], set()
    for k in range(0, 80, 10):
        words = prose(rng, 60)
        rows += [(k, k, words), (k + 1, k, words), (k + 1, k + 1, words + " tail"), (k + 2, k + 1, words + " tail"), (k + 1, rng.randrange(10**6, 10**9), prose(rng, 60))]
        want.add((k, k + 1))
    links = minhash._leader_rounds(spark.createDataFrame(rows, "block long, id long, body string"), minhash.Params(leaders=1)).collect()
    assert {(min(r), max(r)) for r in links} == want


def test_near_edge_cases(spark, odd, empty):
    assert minhash.near_classes(odd).count() == len(ODD)
    assert minhash.near_classes(empty).count() == 0
    kept = minhash.drop_near(docs_of(spark, near_rows()))
    assert kept.count() == len(set(brute_near(near_rows()).values()))


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(40):
        keys = np.sort(rng.integers(0, 1 << 62, 60).astype(np.uint64))
        a = rng.integers(0, 14, 60)
        b = np.where(rng.random(60) < 0.6, a, rng.integers(0, 14, 60))
        one, two = (minhash.signature(keys[c > 0], c[c > 0], 512) for c in (a, b))
        off.append((one == two).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.03


# --------------------------------------------------------------- whole queries
def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    base = [prose(rng, 80) for _ in range(12)]
    rows = [(i, base[i % 12] if i < 24 else (base[i % 12] + " tail" if i < 30 else prose(rng, 70))) for i in range(40)] + [(50, "### " * 80), (51, None), (52, "short")]
    docs_of(spark, rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    good = [(i, t) for i, t in rows if t and len(t.split()) >= 50 and "#" not in t]
    last = {t: i for i, t in good}
    kept = [(i, t) for i, t in good if last[t] == i]
    classes = brute_near(kept)
    assert set(out.doc_id) == set(classes.values())
    assert out.groupby("doc_id").length.sum().eq(out.groupby("doc_id").doc_tokens.first()).all()


def test_registry():
    names = registry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(names)
