"""Sharding, token files and substring removal against plain Python."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoweave.llm import sharding, substring_dedup, token_files, tokens
from llm_helpers import SF_SMALL, make_docs  # noqa: F401


def awkward(seed=1, n=60):
    r = random.Random(seed)
    vocab = ["a", "bb", "ñu", "日本", "x,", "y."]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60))), r.choice("abc")) for i in range(n)]
    rows += [(100, None, None), (101, "", "a"), (None, "a bb " * 20, "a"), (None, None, None),
             (5, rows[5][1], "b"), (5, "other  text\n here ", "b"), (7, rows[7][1], rows[7][2]), (102, "a " * 20000, "c"),
             (103, "tab\there\x0b \x0c nbsp em", "c")]
    return rows


def test_shards(spark, make_docs):
    rows = awkward()
    for n, buckets in ((7, 4), (200, 64)):
        out = sharding.interleave_shards(make_docs(rows), n, rows_per_bucket=5, least_buckets=buckets).collect()
        assert len(out) == len(rows)
        sizes = [sum(r.shard == s for r in out) for s in range(n)]
        assert sizes == sharding.shard_sizes(len(rows), n)
        for s in range(n):
            assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
            (i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, _ in rows)
        assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}
    assert sharding.interleave_shards(make_docs([]), 3).count() == 0


def test_shards_follow_the_definition(spark):
    """Brute force: shuffle by md5 within the source, order by fractional rank, cut."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    by = defaultdict(list)
    for r in rows:
        h = int(hashlib.md5(f"20:{r.doc_id}".encode()).hexdigest()[:15], 16)
        by[r.source].append((h, r.doc_id))
    flat = []
    for s, x in by.items():
        flat += [((2 * i + 1) / (2 * len(x)), "=" + s, d) for i, (_, d) in enumerate(sorted(x))]
    flat.sort()
    want = {d: g * 40 // len(flat) for g, (_, _, d) in enumerate(flat)}
    got = {r.doc_id: r.shard for r in sharding.interleave_shards(docs, 40).collect()}
    assert got == want


def test_encoder_is_the_tokenizer():
    enc = tokens.encoder()
    texts = [t or "" for _, t, _ in awkward()] + ["a  b", "x\n y", " ", "  ", "\n\nq r\n", "<|endoftext|> z", "don't we'll", "\ta b\t",
                                                   "a \x1cb", "日本 語 ñ​é"]
    for t, ids in zip(texts, enc.encode_many(texts, 50)):
        want = enc.tokenizer.encode(t, add_special_tokens=False)
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == want.ids
        a, b = enc.spans(t, ids)
        assert list(zip(a.tolist(), b.tolist())) == want.offsets


def test_new_words_are_cut_into_pieces():
    """Words of printable ASCII go to the model in the pieces of the tokenizer's split
    pattern, which come again more often than words; the ids stay the tokenizer's."""
    import random
    rnd = random.Random(3)
    some = ["'s", "'t", "'re", "'ll", "'", "s", "ab", "Z9", "12", "--", ",", "\n", "\n\n", "\u00e9", "\u00ff", "\u00d7", "\u00df", "\u00aa",
            "\u00b5", "\u00a0", "\u00ad", "\u00bd", "\u4e2d", "\t", "_", "\x1c", "\x0b", "\x7f", "~"]
    texts = [" ".join("".join(rnd.choice(some) for _ in range(rnd.randrange(6))) for _ in range(rnd.randrange(1, 12))) for _ in range(3000)]
    texts += [" ".join(f"{a}{b}{c}" for a in ("x", "y", "z") for b in (",", ".") for c in range(40))] * 2
    enc, num = tokens.TextEncoder(tokens.default_path(), 500), tokens.TextEncoder(tokens.default_path(), 500, True)
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_many(texts)] == want
    assert num.encode_many(texts) == [len(x) for x in want]
    enc.forget()
    enc.encode_many(texts[-1:])
    assert len(enc.cache) == 240 and len(enc.pieces) == 3 + 2 + 40


def test_texts_of_common_alphabets_are_cut_whole():
    """Latin, Greek and Cyrillic texts with any white space are cut by the split pattern and keep no
    words; whatever a text holds, its ids are the tokenizer's."""
    rnd = random.Random(9)
    known = [*tokens._KNOWN, "'s", "'ll", "'ve", "'S", " ", "  ", "\n ", " \n", "\u4e2d", "\U0001f600", "\u2028", "\u3000", "\u0378", "<|endoftext|>"]
    texts = ["".join(rnd.choice(known) + rnd.choice(["", "", " ", "ab"]) for _ in range(rnd.randrange(1, 40))) for _ in range(4000)]
    texts += [f"{a}{c}{b}" for c in tokens._KNOWN for a, b in (("a", "b"), (" ", " "), ("1", "  2"), ("'", "s"))]
    texts += ["x" * 1000, " " * 1000 + "x", "\u00e9" * 70 + " \u00e9"]
    enc, num = tokens.TextEncoder(tokens.default_path(), 5000), tokens.TextEncoder(tokens.default_path(), 5000, True)
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for t, x, ids in zip(texts, enc.encode_many(texts, 10_000), want):
        assert np.frombuffer(x, "<u4").tolist() == ids, repr(t)
    assert num.encode_many(texts, 10_000) == [len(x) for x in want]
    assert max(map(len, enc.pieces)) <= 64
    enc.forget()
    text = "ein  \u00fcber\nZaun, \u043d\u0435 the  one, an\u0303o "
    enc.encode_many([text] * 3)
    assert not enc.cache and set(enc.pieces) == set(tokens._SPLIT(text))


def test_token_files_round_trip(spark, make_docs, tmp_dir):
    rows = awkward()
    docs = make_docs(rows)
    token_files.write_shards(docs, f"{tmp_dir}/t", block_ids=64)
    nb = token_files.write_index(spark, f"{tmp_dir}/t", keys_per_bucket=9)
    out = token_files.read_documents(spark, f"{tmp_dir}/t", docs.select("doc_id").distinct(), nb).collect()
    enc = tokens.encoder()
    want, start = [], 0
    for i, t in sorted(((i, t) for i, t, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, out)) == Counter(want)
    absent = spark.createDataFrame([(10 ** 6,), (-3,)], "doc_id long")
    assert token_files.find(spark, f"{tmp_dir}/t", absent, nb).count() == 0


def scanned(df):
    """Rows that the scan below an executed DataFrame gave."""
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_lookup_reads_the_blocks_it_names(spark, make_docs, tmp_dir):
    rows = awkward() + [(1000 + i, f"word{i} " * 40) for i in range(400)] + [(5, "more of the same key " * 30)] * 8
    docs, root = make_docs(rows), f"{tmp_dir}/lookup"
    token_files.write_shards(docs, root, block_ids=200)
    nb = token_files.write_index(spark, root, keys_per_bucket=30)
    enc = tokens.encoder()
    want = defaultdict(list)
    for i, t in sorted(((i, t) for i, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        want[i].append(enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    all_blocks = spark.read.parquet(f"{root}/shards").select("part", "first", "last", "keys").collect()
    for keys in ([1234], [5], [None], [102, 1000, 1399, 1399, 77777], [77777], []):
        out = token_files.lookup(spark, root, keys, nb)
        got = defaultdict(list)
        for r in sorted(out.collect(), key=lambda r: r.copy):
            assert r.copy == len(got[r.key])
            got[r.key].append(r.ids)
        assert got == {k: want[k] for k in keys if k in want}
        if got:
            assert scanned(out) == sum(bool(set(b["keys"]) & set(got)) for b in all_blocks) < len(all_blocks) / 2
    every = token_files.lookup(spark, root, list(want), nb).collect()
    assert sorted(map(tuple, ((r.key or -1, r.copy, tuple(r.ids)) for r in every))) == sorted(
        (k or -1, c, tuple(x)) for k, xs in want.items() for c, x in enumerate(xs))


def test_token_files_of_no_documents(spark, make_docs, tmp_dir):
    docs = make_docs([])
    token_files.write_shards(docs, f"{tmp_dir}/t")
    nb = token_files.write_index(spark, f"{tmp_dir}/t")
    assert token_files.read_documents(spark, f"{tmp_dir}/t", docs.select("doc_id").distinct(), nb).count() == 0


def brute_substrings(rows, w):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    low = {}
    for (i, _), x in zip(rows, words):
        if i is not None:
            for a in range(len(x) - w + 1):
                k = tuple(x[a:a + w])
                low[k] = min(low.get(k, i), i)
    out = []
    for (i, _), x in zip(rows, words):
        gone = set()
        if i is not None:
            for a in range(len(x) - w + 1):
                if low[tuple(x[a:a + w])] < i:
                    gone.update(range(a, a + w))
        kept = " ".join(v for j, v in enumerate(x) if j not in gone)
        out.append((i, len(x), len(gone), kept))
    return out


@pytest.mark.parametrize("w,params", [(3, {}), (13, dict(windows_per_bucket=64, bytes_per_group=300, windows_per_batch=50))])
def test_substrings(spark, make_docs, w, params):
    rows = [(i, t) for i, t, _ in awkward(3, 80)]
    rows += [(200 + j, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " + "z " * j) for j in range(5)]
    out = substring_dedup.substring_dedup(make_docs(rows), window=w, **params).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == Counter(brute_substrings(rows, w))
    for r in out:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


@pytest.mark.parametrize("params", [{}, dict(windows_per_batch=1)])
def test_substrings_whose_first_hashes_agree(spark, make_docs, params):
    """Different windows of two words, equal in the 48 bits that are kept of their first hash."""
    pairs = [("v2634 v5869", "v2587 v3582"), ("v4187 v7579", "v595 v6112"), ("v740 v3923", "v439 v363")]
    rows = [r for i, (a, b) in enumerate(pairs) for r in [(10 * i, f"x{i} {a} y{i}"), (10 * i + 1, f"z{i} {b} u{i}")]]
    rows += [(40, "v740 v3923 r"), (41, "s v439 v363"), (42, "v439 v363 q v740 v3923"), (43, "t v595 v6112")]
    for part in (rows, rows[::-1]):
        out = substring_dedup.substring_dedup(make_docs(part, 2), window=2, **params).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == Counter(brute_substrings(part, 2))
    assert sum(r.n_removed for r in out) == 10


def test_substrings_of_no_documents(spark, make_docs):
    assert substring_dedup.substring_dedup(make_docs([])).count() == 0


def test_substring_query_on_the_small_table(spark):
    from chronoweave.llm.queries import op3_substring_dedup
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {tuple(r) for r in op3_substring_dedup(spark, SF_SMALL).collect()}
    assert got == {(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in brute_substrings(rows, 13)}
