from churnloom.llm import common, line_dedup

SCHEMA = "doc_id long, text string, source string, n_lines string"


def rows():
    out = [(i, f"Menu\nbody {i}\n \tMenu \n\nfoot {i % 2}", "a", "old") for i in range(20)]
    out += [(100 + i, f"Menu\nbody {i}", "b", "old") for i in range(2)]
    out += [(200 + i, "Menu\nx", None, "old") for i in range(3)]
    out += [(300, None, "a", "old"), (301, "", "a", "old"), (302, "body 1", "a", "old"), (302, "body 1", "a", "old")]
    return out


def brute(data, ratio=0.02, least=3):
    sites = {}
    for _, t, s, _ in data:
        sites.setdefault(s, []).append({x.strip(" \t\r") for x in t.split("\n")} if t is not None else set())
    out = []
    for i, t, s, _ in data:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        n = len(sites[s])
        bad = lambda x: x and sum(x in p for p in sites[s]) >= least and sum(x in p for p in sites[s]) > n * ratio
        kept = [x for x in lines if not bad(x.strip(" \t\r"))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert result(line_dedup.drop_boilerplate(df)) == brute(rows())
    assert result(line_dedup.drop_boilerplate(df, ratio=0.6)) == brute(rows(), ratio=0.6)


def test_salted_join_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA)
    monkeypatch.setattr(common, "BROADCAST_ENTRIES", 0)
    assert result(line_dedup.drop_boilerplate(df, slice_rows=4)) == brute(rows())


def test_long_text_and_empty_table(spark):
    long = "\n".join(["same"] * 5000 + [f"l{i}" for i in range(20000)])
    df = spark.createDataFrame([(i, long, "a", "") for i in range(4)], SCHEMA)
    assert [r["n_dropped"] for r in line_dedup.drop_boilerplate(df).collect()] == [25000] * 4
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], SCHEMA)).collect() == []
