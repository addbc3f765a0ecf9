import random
import re

import pytest

from duoscope.llm import surrogates as S
from tests.llm.util import ODD, frame, prose

KEY = b"test"
FOUND = [("mail a.b@Mail7.example.com.", "email", "a.b@Mail7.example.com"), ("at 10.20.30.40, x", "ipv4", "10.20.30.40"),
         ("call +1 (017) 555-7713 now", "phone", "+1 (017) 555-7713"), ("no 9807915762804490 x", "card", "9807915762804490"),
         ("x +1*** (017)### 555-7713%%% y", "phone", "+1*** (017)### 555-7713"), ("4111 1111 1111 1111", "card", "4111 1111 1111 1111"), ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
         ("api_key: abcdEFGH1234", "secret", "abcdEFGH1234"), ("iban DE89 3704 0044 0532 0130 00", "iban", "DE89 3704 0044 0532 0130 00"),
         ("ssn 123-45-6789.", "ssn", "123-45-6789"), ("mac 00:1A:2B:3C:4D:5E", "mac", "00:1A:2B:3C:4D:5E"), ("v6 fe80::1:2 x", "ipv6", "fe80::1:2"),
         ("Mrs. Smith", "family", "Smith"), ("Госпожа Иванова", "family", "Иванова")]


@pytest.mark.parametrize("text, kind, value", FOUND)
def test_found_and_replaced_in_form(text, kind, value):
    (a, b, k, norm), = S.find(text)
    assert k == kind and text[a:b] == value
    new, (mark,) = S._rewrite(text, S.find(text), [0], KEY)
    got = new[mark["start"]:mark["end"]]
    assert value not in new and new[:mark["start"]] == text[:a] and new[mark["end"]:] == text[b:]
    if kind in ("phone", "card", "iban", "ssn", "secret", "email"):
        assert re.sub(r"\d", "0", re.sub(r"[^\W\d_]", "a", got)) == re.sub(r"\d", "0", re.sub(r"[^\W\d_]", "a", value))
    if kind == "card":
        digits = re.sub(r"\D", "", value), re.sub(r"\D", "", got)
        assert S._luhn(digits[0]) == S._luhn(digits[1])
    if kind == "family":
        assert S._script(got[0]) == S._script(value[0]) and got[0].isupper()
    again = S.find(new)
    assert [x[2] for x in again] == [kind]


def test_gender_and_coreference_in_a_text():
    text = "Mr John Smith wrote; later Smith and Mrs Mary Smith met Dr Jones. SMITH? Smithson"
    new, marks = S._rewrite(text, S.find(text), [0] * 99, KEY)
    given = [new[m["start"]:m["end"]] for m in marks if m["kind"].startswith("given")]
    assert given[0] in S.GIVEN["Latin", "m"].split() and given[1] in S.GIVEN["Latin", "f"].split()
    family = [new[m["start"]:m["end"]] for m in marks if m["kind"] == "family"]
    assert len(set(family[:3])) == 1 and family[3] != family[0] and new.endswith("Smithson")


def test_clean_texts_stay():
    for t in ["Version 1.2.3.4.5 of 2024-01-02, 12:30:45", "pi 3.14159265358979", "a@b", "tokens = many", "C++ std::vector", "1,234,567.89", "x" * 500, "Mr is short"]:
        assert S.find(t) == [], t


def test_long_odd_texts_end():
    for t in ("a." * 50000, "1 " * 50000, "a@" * 50000, ":" * 100000, "12-" * 30000, "Mr " * 30000):
        S.find(t)


def test_documents(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        w = prose(rng, 40)
        for text, *_ in rng.sample(FOUND, 3):
            w.insert(rng.randrange(40), text)
        rows.append((i, "\n".join(w), "en", "s"))
    rows += [(100 + i, t, "en", "s") for i, t in enumerate(ODD)] + [rows[0], (None, "Mrs. Smith", "en", "s")]
    docs = frame(spark, rows)
    got = S.replace_pii(docs, KEY).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t, *_ in rows}
    mapped, back = {}, {}
    for r in got:
        found = S.find(text[r.doc_id] or "")
        assert len(found) == len(r.entities) and (found or r.text == text[r.doc_id])
        for (a, b, kind, norm), e in zip(found, r.entities):
            new = r.text[e["start"]:e["end"]]
            if kind == "phone":             # one number in two notations
                new = re.sub(r"[^0-9+]", "", new)
            mapped.setdefault((kind, norm), set()).add(new.lower())
            back.setdefault((kind, new.lower()), set()).add(norm)
    assert all(len(v) == 1 for v in mapped.values()) and all(len(v) == 1 for v in back.values())
    monkeypatch.setattr(S, "BLOCK", 1)
    assert sorted(map(str, S.replace_pii(docs, KEY).collect())) == sorted(map(str, got))
    assert S.replace_pii(docs.limit(0), KEY).count() == 0


def test_collisions_are_resolved(spark):
    """More given names than there are choices, and real names among the choices."""
    names = [f"nam{i}" for i in range(120)] + [x.casefold() for x in S.GIVEN["Latin", "m"].split()]
    real = spark.createDataFrame([("given-m", n) for n in names] + [("ipv4", f"10.0.0.{i}") for i in range(50)], "kind string, norm string")
    out = S.resolve(real, KEY).collect()
    assert len(out) == len(names) + 50 and len({(r.kind, r.new) for r in out}) == len(out)
    assert not {(r.kind, r.new) for r in out} & {(r.kind, r.norm) for r in out}
    assert all(r.new == S.surrogate(KEY, r.kind, r.norm, r.attempt) for r in out)
    assert any(r.attempt > 0 for r in out)


def test_many_moved_entities_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 20)
    rows = [(i, f"Mr {chr(65 + i % 26)}am{'abcdefghij'[i // 26]}x Doe came", "en", "s") for i in range(150)]
    got = S.replace_pii(frame(spark, rows), KEY).collect()
    given = {r.text[e["start"]:e["end"]] for r in got for e in r.entities if e["kind"] == "given-m"}
    assert len(given) == 150


MASKED = ['password: "******"', "Password: ........", "token = ----------", "pwd='______'", "password=\"''\""]


def test_masked_values_are_no_entities():
    for text in MASKED:
        assert S.find(text) == [], text
    for text, value in [("password: \"it's'mine\"", "it's'mine"), ("token='a\"b\"c\"d'", 'a"b"c"d')]:
        (a, b, kind, norm), = S.find(text)
        assert kind == "secret" and text[a:b] == norm == value


def test_digits_of_other_scripts_are_replaced():
    arabic = str.maketrans("0123456789", "".join(chr(0x660 + i) for i in range(10)))
    for plain, kind in [("123-45-6789", "ssn"), ("4111 1111 1111 1111", "card"), ("+1 (017) 555-7713", "phone")]:
        text = plain.translate(arabic)
        (_, _, k, norm), = S.find(text)
        assert k == kind and [(k, norm)] == [x[2:] for x in S.find(plain)]
        new, _ = S._rewrite(text, S.find(text), [0], KEY)
        assert new != text and S._ascii(new) == S._rewrite(plain, S.find(plain), [0], KEY)[0]


def test_small_forms_end(spark):
    """Masked values, ::1 to ::f, all one-letter mailboxes, a full private net and unchangeable secrets."""
    rows = [*MASKED, *(f"v6 ::{c} x" for c in "123456789abcdef"), *(f"mail {c}@mail.example.com" for c in "abcdefghijklmnopqrstuvwxyz"),
            'password: "****1*"', 'password: "****2*"', 'password: "\u00aa\u00aa\u00aa\u00aa\u00aa\u00aa"', "mail %%@x.com", "mail %%@y.com"]
    rows.append("\n".join(f"at 192.168.{i}.{j}, x" for i in range(150) for j in range(256)))
    got = S.replace_pii(frame(spark, [(i, t, "en", "s") for i, t in enumerate(rows)]), KEY).collect()
    assert len(got) == len(rows)
    real, new = set(), []
    for r in got:
        found = S.find(rows[r.doc_id])
        assert len(found) == len(r.entities)
        real |= {(k, n) for _, _, k, n in found}
        new += [(e["kind"], r.text[e["start"]:e["end"]]) for e in r.entities]
    assert {r.text for r in got if r.doc_id < len(MASKED)} == set(MASKED)
    # ::a to ::f hold no digit and are no entities
    assert len(new) == len(set(new)) == len(real) and len(new) >= 150 * 256 + 9 + 26 + 5 and not set(new) & real


@pytest.mark.parametrize("kind, norm, found", [
    ("ssn", "123456789", "123-45-6789"), ("card", "4111111111111111", "4111 1111 1111 1111"), ("card", "4111111111112", "4111111111112"),
    ("phone", "+4912345", "+49 123 45"), ("iban", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"),
    ("mac", "00:1a:2b:3c:4d:5e", "00:1A:2B:3C:4D:5E"), ("ipv4", "192.168.1.2", "192.168.1.2"), ("ipv4", "8.8.8.8", "8.8.8.8")])
def test_later_attempts_are_longer_and_complete(kind, norm, found):
    seen = {S.surrogate(KEY, kind, norm, n) for n in range(20)}
    assert len(seen) == 20 and norm not in seen
    for n in (S.FORMED, 19):
        new = S.surrogate(KEY, kind, norm, n)
        assert re.sub(r"[^0-9a-zA-Z+]", "", S.form(kind, found, norm, new)).lower() == re.sub(r"[^0-9a-zA-Z+]", "", new).lower()
        if kind == "card":
            assert S._luhn(new) == S._luhn(norm)


def test_one_gender_per_given_name_in_a_text():
    text = "Mr James Smith and Dr James Smith met Prof Xandra Lee; Frau Xandra Lee and Dr Quillon Ray left. Dr Mary Roe."
    spans = S.find(text)
    kinds = {norm: kind for _, _, kind, norm in spans if kind.startswith("given")}
    assert kinds == {"james": "given-m", "xandra": "given-f", "quillon": "given-n", "mary": "given-f"}
    new, marks = S._rewrite(text, spans, [0] * 99, KEY)
    names = [(norm, new[m["start"]:m["end"]]) for (_, _, _, norm), m in zip(spans, marks)]
    assert all(len({v for n, v in names if n == norm}) == 1 for norm, _ in names)


def test_names_with_one_letter_before_the_apostrophe():
    for text, names in (("Mr O'Brien came", ["O'Brien"]), ("Mme Anne D’Arcy came", ["Anne", "D’Arcy"])):
        assert [text[a:b] for a, b, _, _ in S.find(text)] == names


def test_country_codes_and_check_digits_stay_valid():
    for number, code in (("+44 20 7946 0958", "+44"), ("+1 212 555 0199", "+1"), ("+353 1 555 0199", "+353"), ("+7 495 555 01 99", "+7")):
        got = [S.surrogate(KEY, "phone", re.sub(r"[^0-9+]", "", number), a) for a in range(5)]
        assert all(x.startswith(code) and len(x) == len(re.sub(r"[^0-9+]", "", number)) for x in got)
    good, bad = "DE89370400440532013000", "DE00370400440532013000"
    assert S._mod97(good[4:] + good[:4]) == 1
    for attempt in range(5):
        new = S.surrogate(KEY, "iban", good, attempt)
        assert S._mod97(new[4:] + new[:4]) == 1 and new != good and new[:2] == "DE" and len(new) == len(good)
        assert len(S.surrogate(KEY, "iban", bad, attempt)) == len(bad)


def test_a_pass_holds_one_block(spark, monkeypatch):
    """However many blocks of moved entities there are, the plan has one pass over the texts."""
    docs = frame(spark, [(i, f"card {4111111111110000 + i} ip 10.0.0.{i}", "en", "s") for i in range(40)]
                 + [(99, " ".join(f"::{i:x}" for i in range(1, 10)), "en", "s")])
    monkeypatch.setattr(S, "BLOCK", 1)
    plan = S.replace_pii(docs, KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
