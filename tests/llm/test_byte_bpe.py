import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from churnloom.llm import byte_bpe, token_counts

SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def encoding():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(8)
    out = [None, "", " ", "\n\n  x", "I'm you'll 'S it's", "été  naïve  x 　 ", "日本語のテキスト 123 ①②", "😀😀👩‍👩‍👧", "<|endoftext|> plain", "a" * 3000, " " * 2000 + "z", "\x00\x1c\x1d\x85​ ok", "٣٤٥ ½"]
    alphabet = "etaoin shrdlu ÄÖüßéñ 0123 .,!?'\n\t-_😀語"
    for _ in range(80):
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(200))))
    words = ["the", " thtion", "ering", " Straße", " niño"]
    out.append("".join(rng.choice(words) for _ in range(30_000)))
    return out + ["the same", "the same"]


@pytest.mark.parametrize("table_words", [byte_bpe.TABLE_WORDS, 3, 0])
def test_round_trip_and_library(spark, encoding, table_words):
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA)
    got = byte_bpe.encode(df, outputs=("n_tokens", "ids", "packed", "decoded"), table_words=table_words).collect()
    assert len(got) == len(rows)
    for r in got:
        want = encoding.encode_ordinary(r["text"] or "")
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert bytes(r["packed"]) == np.array(want, "<u4").tobytes()
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_query_digests(spark, encoding, tmp_path):
    from churnloom.llm.queries import QUERIES

    spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts()):
        ids = encoding.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_rank_map_is_a_literal(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    ranks = {b"a": 0, b"b": 1, b"ab": 2}
    plan = df.select(byte_bpe.fold_words(byte_bpe.words_of(df["text"]), byte_bpe.Merges(ranks)).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan


def test_pieces_that_merges_do_not_reach(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"xyz": 257}
    df = spark.createDataFrame([(["xyz", "xy", "abab", "xyzab"],)], "w array<string>")
    got = df.select(byte_bpe.fold_words(df["w"], byte_bpe.Merges(ranks)).alias("x")).first()["x"]
    assert got == [[257], [120, 121], [256, 256], [120, 121, 122, 256]]


def test_pairs_stand_at_their_places():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    most = max(ranks.values())
    unit = 1 << (most + 3).bit_length()
    places, table = byte_bpe.pack_pairs(ranks, unit)
    pairs = {(ranks[p[:i]], ranks[p[i:]]): r for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks}
    assert all(table[places[a] + b] == a * unit + r for (a, b), r in pairs.items())
    # Every other entry is free, and null: as numbers they cost the driver memory.
    assert sum(x is not None for x in table) == len(pairs) and len(table) < 2**19


def test_pairs_are_looked_up_without_search(spark):
    df = spark.createDataFrame([(["ab"],)], "w array<string>")
    ranks = {b"a": 0, b"b": 1, b"ab": 2}
    plan = df.select(byte_bpe.fold_words(df["w"], byte_bpe.Merges(ranks)).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    # The one search left is for the place of the least pair in its word.
    assert plan.count("array_position") == 1


@pytest.mark.parametrize("seed", range(4))
def test_fold_on_untrained_vocabularies(spark, seed):
    # Ranks without order by length: later merges may have lower ranks, and one piece several splits that overlap ("aba").
    rng = random.Random(seed)
    pieces = [bytes([i]) for i in range(256)]
    longer = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 5))) for _ in range(25)} | {b"ab", b"ba", b"aba"})
    rng.shuffle(longer)
    ranks = {p: i for i, p in enumerate(pieces + longer)}
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["ababa" * 20, "é\x00ab"]
    got = spark.createDataFrame([(words,)], "w array<string>").select(byte_bpe.fold_words(byte_bpe.c("w"), byte_bpe.Merges(ranks)).alias("x")).first()["x"]
    for w, ids in zip(words, got, strict=True):
        w = w.encode()
        assert ids == ([ranks[w]] if w in ranks else [ranks[p] for p in byte_bpe.merge_bytes(w, ranks)])


def test_texts_do_not_pass_through_python(spark, sf):
    from churnloom.llm.queries import QUERIES

    plan = QUERIES["op5_byte_bpe"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    python = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert python and all("doc_id#" in line and "text#" not in line for line in python)
    df = spark.createDataFrame([(1, "the same", "old")] * 2, SCHEMA)
    got = byte_bpe.encode(df, keep=("ids", "doc_id"))
    assert got.columns == ["doc_id", "n_tokens", "ids"] and [r["n_tokens"] for r in got.collect()] == [2, 2]


def test_empty_table(spark):
    assert byte_bpe.encode(spark.createDataFrame([], SCHEMA)).collect() == []


def test_length_histogram_against_brute_force(spark, encoding):
    data = texts()
    sizes = [len(encoding.encode_ordinary(t or "")) for t in data]
    df = spark.createDataFrame([(t, 1) for t in data], "text string, length int").repartition(3)
    hist = token_counts.length_histogram(token_counts.lengths(df))
    got = {r["length"]: r for r in hist.collect()}
    assert sorted(got) == sorted(set(sizes))
    for limit, r in got.items():
        longer = [s for s in sizes if s > limit]
        assert (r["n_docs"], r["n_longer"], r["tokens_longer"]) == (sizes.count(limit), len(longer), sum(longer))
        assert r["tokens_fit"] == sum(sizes) - sum(longer) and r["tokens_truncated"] == sum(min(s, limit) for s in sizes)
        assert r["quantile"] == (len(sizes) - len(longer)) / len(sizes) and r["tokens_total"] == sum(sizes)
    limits = {r["limit"]: r for r in token_counts.at_limits(hist, [0, 7, 10**6]).collect()}
    for limit, r in limits.items():
        assert r["n_fit"] == sum(s <= limit for s in sizes) and r["tokens_truncated"] == sum(min(s, limit) for s in sizes)
    assert token_counts.quantile_length(hist, 0.5) == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    empty = spark.createDataFrame([], "text string")
    assert token_counts.length_histogram(token_counts.lengths(empty)).collect() == []
