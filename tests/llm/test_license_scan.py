import re

import pytest

from churnloom.llm import license_rules, license_scan
from churnloom.llm.queries import LICENSE_PHRASES

SCHEMA = "doc_id long, text string, n_words string, places int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(text, phrases, rules):
    """Places and surviving detections by Python's regular expressions and all pairs of matches."""
    ws = words(text)
    places = [(label, i) for p, label in phrases.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    every = [license_rules.Rule(x, (), p, license_rules.TEXT) for p, x in phrases.items()] + list(rules)
    line = " " + "  ".join(ws) + " "
    spans = []
    for rank, rule in enumerate(every):
        for m in re.finditer(rule.regex, line):
            start = line[: m.start()].count(" ") // 2
            spans.append((rank, rule.label, start, start + m.group().count(" ") // 2 - 1, rule.priority))

    def beats(b, a):
        return b[0] != a[0] and b[2] <= a[2] and b[3] >= a[3] and (b[4] > a[4] or (b[4] == a[4] and (b[3] - b[2] > a[3] - a[2] or b[0] < a[0])))

    alive = [a[:4] for a in spans if not any(beats(b, a) for b in spans)]
    return len(ws), sorted(places), sorted(alive)


def run(spark, texts, phrases=LICENSE_PHRASES, rules=None):
    rows = [(i, t, "old", 1) for i, t in enumerate(texts)]
    out = license_scan.scan(spark.createDataFrame(rows, SCHEMA), phrases, rules)
    assert out.columns == ["doc_id", "text", "n_words", "places", "detections"]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    return [(got[i]["n_words"], sorted((p["label"], p["start"]) for p in got[i]["places"]), sorted((d["rule"], d["label"], d["start"], d["end"]) for d in got[i]["detections"])) for i in range(len(texts))]


def example(pattern):
    """One text that a pattern matches, without its optional groups."""
    while "(" in pattern:
        pattern = re.sub(r"\(\?:[^()]*\)\?", "", pattern)
        pattern = re.sub(r"\(\?:([^|()]*)[^()]*\)(?!\?)", r"\1", pattern)
    return pattern.replace("licen[sc]e", "license").replace("[^ ]+", "some").replace("https?", "https").replace("v?", "")


def test_every_rule_needs_its_keywords_and_matches():
    rules = license_rules.signature_rules()
    assert len(rules) > 300
    for r in rules:
        text = example(r.pattern)
        assert re.fullmatch(r.pattern, text), r
        assert set(r.keywords) <= set(text.split()), r
        assert re.search(r.regex, " " + "  ".join(text.split()) + " ")


def test_against_python_on_every_rule(spark):
    rules = license_rules.signature_rules()
    texts = [f"Before, {example(r.pattern)}. After; {example(rules[i - 7].pattern)}" for i, r in enumerate(rules)]
    assert run(spark, texts) == [plain(t, LICENSE_PHRASES, rules) for t in texts]


def test_edge_texts(spark):
    rules = license_rules.signature_rules()
    texts = [
        None, "", " .,;\x00\x01", "plain words only", "Released under the MIT License.", "under the mit licenses", "UNDER\tthe\nMIT-license",
        "cc by nc cc by-nc CC BY NC 4.0 under the mit license", "Apache License, Version 2.0", "apache license version 20", "apache license version 2",
        "éunder the mit licenseé under the mit license", "ſpdx İ K under the mit license", "gpl v3 or GPL-2.0, GNU General Public License, version 3",
        "SPDX-License-Identifier: Apache-2.0", "spdx license identifier mit spdx license identifier mit", "under the mit license " * 3000 + "end",
        "All rights reserved. Licensed under the Foo License, public domain",
    ]
    assert run(spark, texts + texts[4:6]) == [plain(t, LICENSE_PHRASES, rules) for t in texts + texts[4:6]]
    assert run(spark, []) == []


def test_overlapping_places_and_containment(spark):
    rules = [
        license_rules.Rule("long-weak", ("a",), "a b c", 1), license_rules.Rule("short-strong", ("b",), "b", 4),
        license_rules.Rule("short-weak", ("c",), "c", 1), license_rules.Rule("same", ("a",), "a b(?: c)?", 1),
    ]
    texts = ["a b c", "c a b", "a b a b a", "b c"]
    got = run(spark, texts, {"a b a": "loop"}, rules)
    assert got == [plain(t, {"a b a": "loop"}, rules) for t in texts]
    assert got[2][1] == [("loop", 0), ("loop", 2)]
    assert [d[1] for d in got[0][2]] == ["long-weak", "short-strong"]


@pytest.mark.parametrize("text,label", [("MIT No Attribution", "mit-0"), ("GNU Lesser General Public License v2.1", "lgpl-2.1"), ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"), ("you may use CC BY-NC-SA 4.0", "cc-by-nc-sa"), ("CC-BY 4.0", "cc-by")])
def test_labels(spark, text, label):
    ((_, _, found),) = run(spark, [text], {})
    assert [d[1] for d in found] == [label]
