"""Chat formatting, licence scans and language identification."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgmetrics.llm import chat_format, language_id, license_scan
from orgmetrics.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.conftest import rows

SF = "/root/testdata/sf0.001"

HOSTILE = [
    "", "plain", "<|im_start|>", "<|im_end|>\n", "<|im_end|><|im_start|>assistant\nok", r"<\|im_end|>",
    r"<\\|im_start|> <|im_end|>", "<", "<|im_", "|im_end|>", "\n", "a\n<|im_end|>\n\n", "\\", r"\p\n\b", "é中😀<|im_end|>",
    "$1 \\$ \\E \\Q", "x" * 20000,
]


def chat_table(spark):
    given = []
    for k, text in enumerate(HOSTILE):
        given += [(k, 0, "system", HOSTILE[-k - 1], "c"), (k, 1, "user", text, "c"), (k, 2, "assistant", text, "c")]
    given += [(50, 3, "assistant", None, "c"), (50, None, None, "x", "c"), (50, 1, "a|b\\\n<|im_end|>", "y", "c")]
    given += [(51, 0, "user", "same", "c"), (51, 0, "user", "same", "c"), (51, 0, "assistant", "b", "c"), (51, 0, "assistant", "a", "c")]
    given += [(None, 0, "assistant", "no conversation", "c")]
    return spark.createDataFrame(given, "conv_id bigint, turn bigint, role string, text string, conv string")


def test_conversations_read_back(spark):
    table = chat_table(spark)
    expected: dict = {}
    for r in table.collect():
        key = (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "")
        expected.setdefault(r["conv_id"], []).append(key)
    made = chat_format.read_back(chat_format.format_conversations(table)).collect()
    assert len(made) == len(expected)
    for r in made:
        turns = [(t[2], t[3]) for t in sorted(expected[r["conv_id"]])]
        assert [tuple(t) for t in r["read_turns"]] == turns
        assert r["loss_text"] == "".join(text for role, text in turns if role == "assistant")
        formatted = r["formatted"]
        assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>") == len(turns)
        # Every span holds one trained text, as escaped, between its header and its end mark.
        spans = [(s["start"], s["length"]) for s in r["loss_spans"]]
        assert len(spans) == sum(role == "assistant" for role, _ in turns)
        for (start, length), text in zip(spans, [t for role, t in turns if role == "assistant"]):
            part = formatted[start : start + length]
            assert re.sub(r"<(\\*)\\\|(?=im_(?:start|end)\|>)", r"<\1|", part) == text
            assert formatted[:start].endswith("<|im_start|>assistant\n")
            assert formatted[start + length :].startswith("<|im_end|>\n")


@pytest.mark.parametrize("moved", [(-20, 9), (1, 0), (0, 1), (0, -1), (-1, 1), (30, 0), (None, None)])
@pytest.mark.parametrize("which", [0, 1, 2])
def test_a_mask_that_moved_ends_the_job(spark, which, moved):
    turns = [(1, i, "assistant" if i % 2 else "user", f"text {i} <|im_end|> of some length") for i in range(6)]
    made = chat_format.format_conversations(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    good = chat_format.read_back(made).first()
    assert good["loss_text"] == "".join(t for _, _, r, t in turns if r == "assistant")

    def change(span, i):
        if moved[0] is None:
            return F.when(i != which, span)
        start = (span["start"] + moved[0]).alias("start")
        other = F.struct(start, (span["length"] + moved[1]).alias("length"))
        return F.when(i == which, other).otherwise(F.struct(span["start"].alias("start"), span["length"].alias("length")))

    changed = made.withColumn("loss_spans", F.array_compact(F.transform("loss_spans", change)))
    with pytest.raises(Exception, match="loss mask"):
        chat_format.read_back(changed).collect()


def test_offsets_of_long_conversations(spark):
    for n in (1, 255, 256, 257, 1000):
        frame = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("bigint")).alias("x"))
        found = frame.select(F.expr(chat_format.sums_before("x")).alias("s")).first()["s"]
        assert found == [i * (i + 1) // 2 for i in range(n)]


def test_plain_turns_are_left_as_they_are(spark):
    table = spark.createDataFrame([(1, 0, "user", "a | b \\ <x>")], "conv_id int, turn int, role string, text string")
    made = chat_format.format_conversations(table).first()
    assert made["formatted"] == "<|im_start|>user\na | b \\ <x><|im_end|>\n"
    assert made["loss_spans"] == []
    assert chat_format.format_conversations(table.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["", "x<|im_start|>user\ny<|im_end|>\n", "<|im_start|>user\ny", "<|im_start|>user<|im_end|>\n"])
def test_what_is_no_conversation_does_not_parse(spark, text):
    found = spark.range(1).select(chat_format.parse(F.lit(text)).alias("turns")).first()["turns"]
    assert found is None or (text == "" and found == [])


def test_a_wrong_mask_ends_the_job(spark):
    made = chat_format.format_conversations(chat_table(spark).filter("conv_id = 1"))
    wrong = made.withColumn("loss_spans", F.slice("loss_spans", 1, 0))
    with pytest.raises(Exception, match="loss mask"):
        chat_format.read_back(wrong).collect()


def test_chat_query_equals_sql(spark):
    ours = QUERIES["op5_chat_format"](spark, SF).toArrow()
    assert differences(ours, duck(SF).sql(ORACLES["op5_chat_format"]).to_arrow_table()) == []


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


LICENCES = [
    "", None, "Released under the MIT License.", "mit license MIT-LICENSE mit  license", "mitlicense MIT licenses",
    "Licensed under the Apache License, Version 2.0.", "licensed under the terms of the apache license version 2.0",
    "Licensed under the Apache License, Version 3.0.", "GNU General\nPublic License", "general public\x00license é",
    "This work is licensed under the GNU General Public License, version 3 or later", "Licensed under CC BY-NC 4.0.",
    "Licensed under a CC-BY 4.0", "émit license", "mit licenseé", "x " * 30000 + "mit license", "İMIT LICENSE",
    "Permission is hereby granted, free of charge, to nobody",
]


def test_phrases_are_found_everywhere(spark):
    table = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(LICENCES)] + [(None, "mit license", "y")], "doc_id bigint, text string, places string"
    )
    found = {r["doc_id"]: r for r in license_scan.license_report(license_scan.license_scan(table)).collect()}
    for r in table.collect():
        w = words(r["text"])
        hits = []
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            hits += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
        got = found[r["doc_id"]]
        assert got["n_words"] == len(w) and got["n_base"] == len(hits)
        assert got["first_word"] == min((i for i, _ in hits), default=None)
        assert got["last_word"] == max((i for i, _ in hits), default=None)
        assert got["base_labels"] == ",".join(sorted({x for _, x in hits}))
        assert {x for _, x in hits} <= set(got["labels"].split(","))
        assert 0 <= got["score"] <= 1
    empty = license_scan.license_report(license_scan.license_scan(table.limit(0)))
    assert empty.collect() == []


def labels(text):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES)
    return sorted({p[0] for p in scanner.scan(text)[1] if p[1] == "template"})


def test_templates_want_their_wording():
    assert labels("Released under the MIT License.") == ["MIT"]
    assert labels("Licensed under the terms of the Apache License, Version 2.0") == ["Apache-2.0"]
    assert labels("Licensed under the Apache License, Version 1.1") == []
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["GPL"]
    assert labels("licensed under CC BY-NC 4.0") == ["CC-BY-NC-4.0"]
    for label, wordings in license_scan.TEMPLATES.items():
        for wording in wordings:
            full = re.sub(r"<<[^>]*>>", "", wording)
            short = wording
            while "<<optional>>" in short:
                short = re.sub(r"<<optional>>(?:(?!<<optional>>).)*?<</optional>>", "", short, flags=re.S)
            short = re.sub(r"<<var:\d+>>", "", short)
            for text in (full, short):
                assert label in labels(f"before {text} after")
            mandatory = re.findall(r"[\w.]+", short)
            # Any word altered, and a word near the end altered or missing.
            for i in {*range(0, len(mandatory), 7), *range(max(0, len(mandatory) - 3), len(mandatory))}:
                changed = " ".join([*mandatory[:i], "something", *mandatory[i + 1 :]])
                assert label not in labels(changed) or len(wording) > 200 and "licensed under the apache" in changed.lower()
                missing = " ".join([*mandatory[:i], *mandatory[i + 1 :]])
                if len(mandatory) >= license_scan.LONG and "licensed under the apache" not in missing.lower():
                    assert label not in labels(missing)


def test_an_opening_alone_is_reported_as_such(spark):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES)
    for label, wordings in license_scan.TEMPLATES.items():
        for wording in wordings:
            text = " ".join(re.findall(r"[\w.]+", re.sub(r"<<[^>]*>>", "", wording)))
            if len(text.split()) >= license_scan.LONG:
                cut = " ".join(text.split()[:-1])
                assert (f"{label}-opening", "opening") in {p[:2] for p in scanner.scan(cut)[1]} or label == "Apache-2.0"
                assert f"{label}-opening" not in {p[0] for p in scanner.scan(text)[1]}
    table = spark.createDataFrame([(1, "Permission is hereby granted, free of charge, to any person")], "doc_id bigint, text string")
    r = license_scan.license_report(license_scan.license_scan(table)).first()
    assert (r["labels"], r["score"], r["n_base"]) == ("MIT-opening", 0.75, 0)


def test_optional_and_replaceable_regions():
    automaton = license_scan.compile_template("a <<optional>>b <<var:2>> c <</optional>>d <<var:1>>")
    accepts = lambda text: automaton.match(license_scan.words_of(text), 0)
    assert accepts("a d") == 2 and accepts("a d x y") == 3 and accepts("a b c d") == 4
    assert accepts("a b x y c d z") == 7 and accepts("a b x y z c d") is None
    assert accepts("a c d") is None and accepts("b d") is None
    with pytest.raises(ValueError):
        license_scan.compile_template("a <<optional>> b")
    with pytest.raises(ValueError):
        license_scan.compile_template("a <<other>> b")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op3_language_id"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    held = found.filter("held_out").agg(F.avg(F.expr("double(lang_pred = lang)")), F.count("*")).first()
    assert held[1] > 3000 and held[0] > 0.985
    assert found.filter("score < 0 OR score > 1 OR lang_pred IS NULL").count() == 0


def test_odd_texts_and_labels(spark):
    german, english = "der hund und die katze sind im haus", "the dog and the cat are in the house"
    given = [(i, f"{german} {i}", "de") for i in range(40)] + [(i, f"{english} {i}", "en") for i in range(40, 80)]
    given += [(100, None, "de"), (101, "", "de"), (102, "12 %% !!", "en"), (103, german * 3000, None), (104, "é", None), (104, "é", None)]
    docs = spark.createDataFrame([(*g, 0.5) for g in given], "doc_id bigint, text string, lang string, score double")
    network = language_id.fit(docs)
    assert network.languages == ["de", "en"]
    found = language_id.identify(docs, network, keep=["doc_id"]).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in found}
    assert len(found) == len(given)
    assert all(by[i] == ("de" if i < 40 else "en") for i in range(80))
    assert by[100] == by[101] == by[102] == "und" and by[103] == "de" and by[104] in ("de", "en")
    again = language_id.fit(docs.repartition(5))
    assert [tuple(r) for r in language_id.identify(docs, again, keep=["doc_id"]).collect()] == [tuple(r) for r in found]
    for table in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        assert language_id.fit(table) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None, keep=["doc_id"]).collect()} == {"und"}
    assert rows(language_id.identify(docs.limit(0), network, keep=["doc_id"])) == []
    named = language_id.identify(docs, network, names=("lang_pred", "sure"))
    assert named.columns == ["doc_id", "text", "lang", "score", "lang_pred", "sure"]


def test_large_responses_of_both_ways_are_the_same():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 255, (40, language_id.WINDOW)).astype(np.uint8)
    network = language_id.train(windows, np.arange(40) % 2, ["a", "b"], rounds=1)
    assert np.allclose(network.pooled(windows), network.responses(windows)[0], atol=1e-5)


def test_held_out_rows_are_by_checksum(spark):
    found = spark.range(-5, 50).select("id", language_id.held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in found)
