from churnloom.llm import chat_format, common, queries

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def brute(rows, size):
    out = []
    groups = {}
    for conv, turn, role, text, _ in rows:
        part = 0 if turn is None else turn // size
        key = (turn is not None, turn if turn is not None else 0, role if role is not None else "unknown", text or "")
        groups.setdefault((conv, part), []).append(key)
    for (conv, part), lines in groups.items():
        lines.sort()
        for who in {x[2] for x in lines} - {"system"}:
            rendered, mask = "", []
            for _, _, role, text in lines:
                name = "system" if role == "system" else "assistant" if role == who else f"user name={role}"
                rendered += f"<|im_start|>{name}\n"
                at = len(rendered)
                rendered += f"{text}<|im_end|>\n"
                if role == who:
                    mask.append((at, len(rendered)))
            out.append((conv, part, who, len(lines), rendered, mask))
    return sorted(out, key=str)


def result(df, **more):
    return sorted(((r["conv_id"], r["part"], r["perspective"], r["n_turns"], r["rendered"], [tuple(s) for s in r["mask"]]) for r in chat_format.rotate(df, **more).collect()), key=str)


def rows():
    out = [(1, i, ["ann", "bob", "cy"][i % 3], f"say {i} é😀", "p") for i in range(9)]
    out += [(2, 0, "system", "be good", "p"), (2, 1, "user", None, "p"), (2, 2, "assistant", "", "p"), (2, 2, "assistant", "tie", "p"), (2, None, "user", "no number", "p")]
    out += [(3, 0, "system", "alone", "p"), (None, 0, None, "who", "p"), (4, 0, "user", "x" * 100_000, "p"), out[0], (5, 700, "user", "late", "p")]
    return out


def test_against_brute_force(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert result(df) == brute(rows(), 256)
    assert result(df, part_turns=2) == brute(rows(), 2)


def test_masks_cover_own_texts_only(spark):
    for _, _, who, _, rendered, mask in result(spark.createDataFrame(rows(), SCHEMA)):
        assert mask
        for a, b in mask:
            assert rendered[:a].endswith("<|im_start|>assistant\n") and rendered[a:b].endswith("<|im_end|>\n")


def test_empty_table_and_no_instructions(spark):
    assert chat_format.rotate(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, 0, "system", "x", "")], SCHEMA)
    assert chat_format.rotate(df).count() == 0
    assert [r["perspective"] for r in chat_format.rotate(df, instructions=()).collect()] == ["system"]


def brute_whole(rows, size):
    groups, out = {}, []
    for conv, turn, role, text, _ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn if turn is not None else 0, role if role is not None else "unknown", text or ""))
    for conv, lines in groups.items():
        lines.sort()
        for part in range(-(-len(lines) // size)):
            told = list(dict.fromkeys(x[2:] for x in lines[: part * size] if x[2] == "system"))
            here = told + [x[2:] for x in lines[part * size : (part + 1) * size]]
            for who in {x[2] for x in lines} - {"system"}:
                rendered, mask = "", []
                for role, text in here:
                    name = "system" if role == "system" else "assistant" if role == who else f"user name={role}"
                    rendered += f"<|im_start|>{name}\n"
                    at = len(rendered)
                    rendered += f"{text}<|im_end|>\n"
                    if role == who:
                        mask.append((at, len(rendered)))
                out.append((conv, part, who, len(here), rendered, mask))
    return sorted(out, key=str)


def whole(df, **more):
    return sorted(((r["conv_id"], r["part"], r["perspective"], r["n_turns"], r["rendered"], [tuple(s) for s in r["mask"]]) for r in chat_format.rotate_whole(df, **more).collect()), key=str)


def long_rows():
    """A long dialogue with sparse numbers, one with null numbers, one of null id; a speaker who is silent after the start."""
    out = [(10, 0, "system", "be kind", "p"), (10, 1, "cy", "hello", "p")]
    out += [(10, 1_700_000_000 + 977 * i, ["ann", "bob"][i % 2], f"say {i}", "p") for i in range(600)]
    out += [(10, 1_700_000_000 + 977 * 400, "system", "be brief", "p"), (10, 1_700_000_001, "system", "be kind", "p")]
    out += [(11, None, ["ann", "bob"][i % 2], f"null {i}", "p") for i in range(300)]
    out += [(None, i, ["ann", None][i % 2], f"lost {i}", "p") for i in range(300)]
    return out


def test_whole_dialogue_for_every_participant(spark, monkeypatch):
    data = rows() + long_rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert whole(df) == brute_whole(data, 256)
    assert whole(df, part_rows=3) == brute_whole(data, 3)
    assert whole(df, part_rows=7, group_rows=50) == brute_whole(data, 7)
    monkeypatch.setattr(common, "BROADCAST_ENTRIES", 0)
    assert whole(df, part_rows=7, slice_parts=4) == brute_whole(data, 7)
    assert whole(spark.createDataFrame([], SCHEMA)) == []


def test_query_gives_the_whole_dialogue(spark, tmp_path):
    data = long_rows()
    spark.createDataFrame(data, SCHEMA).drop("part").write.parquet(f"{tmp_path}/conversations.parquet")
    got = [r for r in queries.op2_chat_format(spark, str(tmp_path)).collect() if r["conv_id"] == 10]
    assert sorted((r["part"], r["perspective"]) for r in got) == [(p, who) for p in range(3) for who in ("ann", "bob", "cy")]
    assert all(r["rendered"].startswith("<|im_start|>system\nbe kind<|im_end|>\n") for r in got)
    for who in ("ann", "bob", "cy"):
        assert "".join(r["rendered"] for r in sorted(got, key=lambda r: r["part"]) if r["perspective"] == who).count("say ") == 600
