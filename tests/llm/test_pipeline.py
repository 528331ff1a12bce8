"""The corpus pipeline against a plain version of every stage, on a small table with the odd cases in it."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from churnloom.llm import byte_bpe, decontaminate, language_id
from .test_line_dedup import brute as plain_lines
from .test_simhash import brute as plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).collect()]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    body = next(t for _, t, lang, _, _ in docs if lang == "en" and t and len(t) > 1500)
    docs += [(9000, None, None, "src0", 0), (9001, "", "en", None, 0), (9002, "12 34 !!", "en", "src0", 8), (9003, body + " " + item + "\n" + body, None, "src1", 9)]
    docs += [(9004, body, "en", "src2", 1), (9004, body, "en", "src2", 1), (None, "The and of with that was. " + body[::-1], "en", None, 3)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(path / "documents.parquet"))
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def same(df, rows):
    assert df.columns == COLUMNS
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)
    return got


def test_stages_against_plain_versions(spark, folder, tmp_path):
    read = f"{folder}/documents.parquet"
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "simhash_neardup", "decontaminate", "byte_bpe"]

    def run(name):
        docs = spark.read.parquet(read)
        rows = [tuple(r) for r in docs.collect()]
        out = f"{tmp_path}/{name}"
        stages[name](spark, docs, folder).write.parquet(out)
        return rows, spark.read.parquet(out), out

    rows, df, out = run("language_id")
    net = language_id.learn(spark.read.parquet(read))
    sure = lambda t: language_id.has_letter((t or "").encode()) and language_id.pool(net, [t.encode()]).max() >= language_id.MIN_SCORE
    kept = same(df, [r for r in rows if sure(r[1])])
    assert len(kept) > 0.95 * len(rows) and not {9000, 9001, 9002} & {r[0] for r in kept}

    read = out
    rows, df, out = run("line_dedup")
    cut = {}
    for r, (_, text, _, _) in zip(sorted(rows, key=lambda r: str((r[0], r[1]))), sorted(plain_lines([(r[0], r[1], r[3], None) for r in rows]), key=lambda r: str(r[0]))):
        cut.setdefault(r[0], []).append(text)
    got = [tuple(r) for r in df.collect()]
    assert df.columns == COLUMNS and len(got) == len(rows)
    texts = {}
    for r in got:
        texts.setdefault(r[0], []).append(r[1])
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in cut.items()}
    assert sorted((r[0], *r[2:]) for r in got if r[0] is not None) == sorted((r[0], *r[2:]) for r in rows if r[0] is not None)

    read = out
    rows, df, out = run("simhash_neardup")
    groups = plain_groups([(r[0], r[1]) for r in rows])
    smallest = {c for _, _, c in groups if c is not None}
    alone = sum(c is None for _, _, c in groups)
    got = [tuple(r) for r in df.collect()]
    assert set(got) <= set(rows) and {r[0] for r in got if r[0] is not None} == smallest and len(got) == len(smallest) + min(alone, 1)

    read = out
    rows, df, out = run("decontaminate")
    index = decontaminate.build_index(benchmark)
    clean = [r for r, hits in zip(rows, decontaminate.search(index, [r[1] for r in rows])) if not hits]
    same(df, clean)
    inside = [r for r in rows if any(decontaminate.normalise(t) in decontaminate.normalise(r[1]) for _, t in benchmark)]
    assert inside and not {r[0] for r in inside} & {r[0] for r in clean}

    read = out
    rows, df, out = run("byte_bpe")
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    want = sorted(((r[0], r[2], r[3], encoding.encode_ordinary(r[1] or "")) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["lang"], r["source"], r["ids"]) for r in df.collect()), key=str) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in df.collect())

    whole = corpus_pipeline.run(spark, folder)
    assert sorted(((r["doc_id"], r["lang"], r["source"], r["ids"]) for r in whole.collect()), key=str) == want


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
