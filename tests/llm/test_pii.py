import hashlib
import random
import re
import sys
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crossmap.llm import pii, queries
from tests.llm import data


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text("a1@.+- ()25é0", max_size=60))
def test_plain_spans(text):
    assert pii.plain_spans(text) == brute(text)


def test_plain_spans_of_generated_identifiers():
    source = random.Random(4)
    for _ in range(300):
        parts = [source.choice(["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "256.1.1.1", "a.b@c.d", "x@y", "+1 (017) 555-7713", "+49", "12", "é", "."]) for _ in range(8)]
        text = source.choice(["", " ", ". "]).join(parts)
        assert pii.plain_spans(text) == brute(text)


@pytest.mark.parametrize("text, kind, wanted", [
    ("mail jоhn@exаmple.com now", "email", "jоhn@exаmple.com"),
    ("mail john [at] example (dot) com now", "email", "john [at] example (dot) com"),
    ("mail john at example dot co dot uk now", "email", "john at example dot co dot uk"),
    ("mail a​@b.com now", "email", "a​@b.com"),
    ("on １９２.１６８.０.１ now", "ip", "１９２.１６８.０.１"),
    ("on one nine two dot one six eight dot zero dot one now", "ip", "one nine two dot one six eight dot zero dot one"),
    ("card ٤١١١ ١١١١ ١١١١ ١١١١ now", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("card four one one one one one one one one one one one one one one one now", "card", "four one one one one one one one one one one one one one one one"),
    ("call plus four nine one two three four five six seven eight now", "phone", "plus four nine one two three four five six seven eight"),
    ("call +49 one two three 45678 now", "phone", "+49 one two three 45678"),
])
def test_disguises_map_back_to_the_source(text, kind, wanted):
    base, added = pii.spans(text)
    assert base == [] or kind == "phone"
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, wanted)]
    assert pii.masked(text) == text.replace(wanted, f"<{kind}>")


@pytest.mark.parametrize("text, kind, wanted", [
    ("write jane [at] example.com", "email", "jane [at] example.com"),
    ("write jane {@} example.com", "email", "jane {@} example.com"),
    ("write jane@example (dot) com", "email", "jane@example (dot) com"),
    ("write jane@example <.> com", "email", "jane@example <.> com"),
    ("write jane at example dot com", "email", "jane at example dot com"),
    ("write jane@example dot com", "email", "jane@example dot com"),
    ("write jane@example point com", "email", "jane@example point com"),
    ("host 10 point 0 point 0 point 1", "ip", "10 point 0 point 0 point 1"),
    ("call plus 49 171 555 0123", "phone", "plus 49 171 555 0123"),
    ("call plus four 9171 555 0123", "phone", "plus four 9171 555 0123"),
    ("call +49 171 555 013 two now", "phone", "+49 171 555 013 two"),
    ("call +49 171 555 013 two.", "phone", "+49 171 555 013 two"),
    ("call +49 171 555 013-two", "phone", "+49 171 555 013-two"),
    ("host 10.0.0.one", "ip", "10.0.0.one"),
    ("host one.0.0.1", "ip", "one.0.0.1"),
    ("call +49 171 55 oh one two three", "phone", "+49 171 55 oh one two three"),
])
def test_every_disguise_is_found_where_it_is_the_only_one(text, kind, wanted):
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)[1]] == [(kind, wanted)]
    assert pii.masked(text) == text.replace(wanted, f"<{kind}>")


@pytest.mark.parametrize("text, kind, wanted", [
    ("on ๑๙๒.๑๖๘.๐.๑ now", "ip", "๑๙๒.๑๖๘.๐.๑"),
    ("card ৪১১১ ১১১১ ১১১১ ১১১১ now", "card", "৪১১১ ১১১১ ১১১১ ১১১১"),
    ("call +𝟒𝟗 𝟙𝟟𝟙 𝟻𝟻𝟻 𝟶𝟷𝟸𝟹 now", "phone", "+𝟒𝟗 𝟙𝟟𝟙 𝟻𝟻𝟻 𝟶𝟷𝟸𝟹"),
    ("mail 𝐣𝐚𝐧𝐞@𝕖𝕩𝕒𝕞𝕡𝕝ℯ.𝖈𝖔𝖒 now", "email", "𝐣𝐚𝐧𝐞@𝕖𝕩𝕒𝕞𝕡𝕝ℯ.𝖈𝖔𝖒"),
    ("mail j𝛂ne@example.com 🎉", "email", "j𝛂ne@example.com"),
    ("🎉 host 𝑜𝑛𝑒 dot 𝟸 dot 3 dot ๔ now", "ip", "𝑜𝑛𝑒 dot 𝟸 dot 3 dot ๔"),
])
def test_digits_and_letters_of_other_scripts(text, kind, wanted):
    added = [(k, text[a:b]) for k, a, b in pii.spans(text)[1]]
    assert added == [(kind, wanted)] and pii.masked(text).count(f"<{kind}>") == 1


@pytest.mark.parametrize("text, wanted", [
    ("mail jane at mail.example dot com now", "jane at mail.example dot com"),
    ("mail jane at a.mail.example [dot] co.uk now", "jane at a.mail.example [dot] co.uk"),
    ("mail jane at mail.example dot co dot uk now", "jane at mail.example dot co dot uk"),
])
def test_written_at_before_literal_and_written_dots(text, wanted):
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)[1]] == [("email", wanted)]


@pytest.mark.parametrize("text", ["john at example.com", "look at mail.example.com", "look at example.com. dot com", "look at example.com and dot", "at " + "a." * 50_000, "x at " * 50_000 + "a.b"])
def test_written_at_before_a_plain_domain_stays(text):
    assert pii.spans(text) == ([], [])


def test_all_decimal_digits_become_ascii():
    digits = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
    assert pii.Normalised("".join(digits)).text == "".join(str(unicodedata.decimal(c)) for c in digits)


def test_time_grows_with_the_number_of_identifiers():
    start = time.time()
    base, added = pii.spans("a@b.com " * 40_000 + "plus 49 171 555 0123, " * 40_000)
    assert len(base) == len(added) == 40_000 and time.time() - start < 20


@pytest.mark.parametrize("text", ["look at the dot", "look at example.com", "one two three", "meet me at five dot", "we are at home. dot com", "Größe außen, señor; où?", "", "at dot at dot", "one of (at least) two"])
def test_clean_texts_stay(text):
    assert pii.spans(text) == ([], []) and pii.masked(text) == text


def test_plain_spans_stay_beside_disguises():
    text = "a@b.com and c [at] d [dot] com and +1 222 333 4444"
    base, added = pii.spans(text)
    assert base == brute(text) and [text[a:b] for _, a, b in added] == ["c [at] d [dot] com"]


@pytest.mark.parametrize("text", ["a" * 400_000 + "@", "1" * 400_000, "+1" + " " * 400_000, " " * 400_000 + "[at]", "at " * 100_000, "one " * 100_000, "@" * 400_000, "1." * 200_000, "​" * 300_000])
def test_time_grows_with_the_text(text):
    start = time.time()
    pii.spans(text)
    assert time.time() - start < 20


def test_rows(spark):
    docs = data.documents(spark, data.ODD + [(7, "x@y.zz \U0001F389 1.2.3.4")])
    found = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    assert [tuple(s) for s in found[7].base] == [("email", 0, 6), ("ip", 9, 16)] and found[2].base == found[3].added == []
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[7] == "<email> \U0001F389 <ip>" and texts[2] is None and texts[5] == data.LONG
    assert pii.find_spans(docs.limit(0)).collect() == [] == pii.mask(docs.limit(0)).collect()


def test_registered(spark):
    found = {r.doc_id: r for r in queries.REGISTERED["op6_pii"](spark, data.SMALL).collect()}
    for identifier, text in data.columns("documents", "doc_id", "text"):
        wanted, row = brute(text), found[identifier]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in wanted) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
