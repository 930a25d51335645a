import hashlib
import time
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row

from covey.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        odd, even = [int(x) for x in digits[-1::-2]], [int(x) * 2 for x in digits[-2::-2]]
        if 13 <= len(digits) <= 19 and (sum(odd) + sum(x // 10 + x % 10 for x in even)) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return found


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", "b.c", ".", " ", "x@y.z", "+1 (555) 555-1234", "4111111111111111", "1.2.3.4", "256.1.1.1", "9", "-", "é", "\n", "+", "00000001"]), max_size=14).map("".join))
def test_plain_spans_are_those_of_the_patterns(text):
    order = lambda x: sorted(x)
    assert order(pii.plain(text)) == order(brute(text))
    base, every = pii.spans(text)
    assert set(base) <= set(every)
    pii.redacted(text)


def seen(text):
    return [(k, text[a:b]) for k, a, b in pii.spans(text)[1]]


def test_disguises_map_back_to_the_source():
    assert seen("write to john dot doe at example dot com now") == [("email", "john dot doe at example dot com")] or seen("write to john dot doe at example dot com now") == [("email", "doe at example dot com")]
    assert seen("mail joe [at] site [dot] org !") == [("email", "joe [at] site [dot] org")]
    assert seen("mail jane(at)mail.example.org.") == [("email", "jane(at)mail.example.org")]
    assert seen("аnna@exаmple.com") == [("email", "аnna@exаmple.com")]  # Cyrillic a
    assert seen("ｊｏｅ＠ｓｉｔｅ．ｃｏｍ") == [("email", "ｊｏｅ＠ｓｉｔｅ．ｃｏｍ")]
    assert seen("call plus one five five five one two three four five six seven today") == [("phone", "plus one five five five one two three four five six seven")]
    assert seen("ip ١٠.٢٠.٣٠.٤٠ end") == [("ip", "١٠.٢٠.٣٠.٤٠")]
    assert seen("card 4111​1111​1111​1111.") == [("card", "4111​1111​1111​1111")]
    assert pii.redacted("joe [at] site [dot] org and 1.2.3.4") == "[EMAIL] and [IP]"


def test_ordinary_text_stays():
    for text in ("She was at the end. One two three go!", "Wir sind um acht am Punkt sieben", "привет мир", "look at this. com", "é è ç à", "un deux trois"):
        assert pii.spans(text) == ([], [])
        assert pii.redacted(text) == text


def test_long_runs():
    zeros = "0" * 6000
    assert pii.plain(f"{zeros}1.2.3.4") == [("ip", 0, 6007)]
    for text in ("a%" * 50_000 + " at b dot", "1-" * 50_000, "one " * 20_000, "@" * 50_000, "a@" * 50_000, "+1" * 50_000, "[at]" * 20_000):
        pii.spans(text)


LONG = {
    "digits": "1" * 1_000_000, "spaces after a bracket": "x) " + " " * 1_000_000, "spaces after a dot": "a at b dot " + " " * 1_000_000, "spaces in an address": "a at b" + " " * 1_000_000 + ". c dot de",
    "brackets": "[ " * 300_000 + "[at]", "names": "a@b" + ".c" * 300_000, "half addresses": "1.1.1 " * 160_000, "digits in words": "one_ " * 200_000, "both": "a [at] b.com " * 20_000 + "c@d.com " * 20_000,
}


@pytest.mark.parametrize("name", LONG)
def test_time_grows_with_the_text(name):
    """A text of about 1 MB takes about a second, whatever it holds; twice the time for twice the text."""
    began = time.process_time()
    pii.redacted(LONG[name])
    assert time.process_time() - began < 8


def test_rows(spark):
    rows = [Row(doc_id=1, text=None, spans="x"), Row(doc_id=None, text="", spans=None), Row(doc_id=3, text="a@b.c " * 9000, spans=None), Row(doc_id=3, text="a@b.c " * 9000, spans=None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = {r["doc_id"]: r for r in pii.detect(df).collect()}
    assert found[1]["spans"] == [] and found[None]["plain_spans"] == [] and len(found[3]["spans"]) == 9000
    assert pii.detect(df).count() == 4 and pii.detect(df.limit(0)).count() == 0
    assert pii.redact(df).where("doc_id = 3").first()["text"] == "[EMAIL] " * 9000


def test_query(spark):
    got = {r["doc_id"]: r for r in pii.op3_personal_data(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        want = sorted(brute(text), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert got[doc_id]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [got[doc_id][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]


@pytest.mark.parametrize("text", ["jane {at} example {dot} com", "jane<at>example<dot>com", "jane{at}example.com", "jane at\nexample dot com", "jane\tat\texample\tdot\tcom", "jane at\nexample.com"])
def test_disguises_need_no_other_mark(text):
    assert pii.spans(text)[1] == [("email", 0, len(text))]
    assert pii.redacted(f"to {text}") == "to [EMAIL]"


def test_bracketed_dots_of_an_address_of_numbers():
    assert pii.spans("10{.}0{.}0{.}1")[1] == [("ip", 0, 14)]


@pytest.mark.parametrize("text,tail", [("j\u043ehn.doe@example.com", 2), ("john[dot]doe@example.com", 9), ("j\u043ehn@10.0.0.1", 2)])
def test_disguised_local_part(text, tail):
    base, found = pii.spans(f"to {text} now")
    assert ("email", 3 + tail, 3 + len(text)) in base and set(base) < set(found)
    assert ("email", 3, 3 + len(text)) in found
    assert pii.redacted(f"to {text} now") == "to [EMAIL] now"


def test_plain_identifiers_are_not_doubled():
    base, found = pii.spans("j\u043ehn at a@b.example and +49 30 1234567, \u0430 c@d.example")
    assert base == found and len(base) == 3
