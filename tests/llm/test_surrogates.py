import itertools
import random
import re

import pytest

from tests_llm_helpers import prose
from wardline.llm import surrogates as s


def kinds(text):
    return [(m.kind, m.value) for m in s.mentions(text)]


@pytest.mark.parametrize("text, expected", [
    ("write to Ann.Lee@Mail.example.com, now", [("email", "ann.lee@mail.example.com")]),
    ("+1 (499) 555-6503 190.137.223.204", [("phone", "+14995556503"), ("ip", "190.137.223.204")]),
    ("call 212-555-0199!!", [("phone", "212-555-0199".replace("-", ""))]),
    ("4111 1111 1111 1111 or 4111111111111111", [("card", "4111111111111111")] * 2),
    ("7536784127813050 1234567890123456 3.14.15", []),
    ("999.1.1.1 1.2.3.4.5", []),
    ("DE89 3704 0044 0532 0130 00", [("iban", "DE89370400440532013000")]),
    ("DE89 3704 0044 0532 0130 01", []),
    ('token = "0123456789abcdef0123"', [("secret", "0123456789abcdef0123")]),
    ("Frau Müller", [("surname", "Müller")]),
    ("the Mrs of it, a miss", []),
    (None, []), ("", []),
])
def test_entities(text, expected):
    assert kinds(text) == expected


@pytest.mark.parametrize("kind, value", [("email", "zoë.b-1@mail4.example.com"), ("phone", "+14995556503"), ("ip", "10.0.0.1"),
                                         ("card", "4111111111111111"), ("iban", "DE89370400440532013000"),
                                         ("secret", "0123456789abcdef0123"), ("surname", "Smith"), ("given_f", "Мария")])
def test_stand_ins_are_of_the_same_kind_and_form(kind, value):
    got = s.surrogate(kind, value, b"k")
    assert got == s.surrogate(kind, value, b"k") and got != s.surrogate(kind, value, b"other") and got != value
    if kind in ("email", "ip", "card", "iban"):
        assert kinds(f"x {got} y") == [(kind, got)]
    if kind == "email":
        assert got.endswith(".com") and re.fullmatch(r"[a-z]{2}[^\W\d_]\.[a-z]-\d@.*", got)
    if kind == "secret":
        assert re.fullmatch(r"[0-9a-f]{20}", got)
    if kind == "given_f":
        assert got in s.GIVEN["f", "cyrillic"]


def test_names_keep_gender_script_and_coreference():
    text = "Mr. John Smith met Mrs Anna Smith. John Smith left."
    names = {f"{m.kind}\x1f{m.value}": s.surrogate(m.kind, m.value, b"k") for m in s.mentions(text)}
    found, count = s.replaced(text, names)
    match = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+)\. (\w+) (\w+) left\.", found)
    assert count == 6 and match[2] == match[4] == match[6] != "Smith" and match[1] == match[5]
    assert match[1] in s.GIVEN["m", "latin"] and match[3] in s.GIVEN["f", "latin"]


def test_stand_ins_are_distinct_and_none_is_real(spark, monkeypatch):
    def narrow(kind, value, key, attempt=0):
        return f"v{(int(value[1:]) * 7 + attempt * 5) % 61}"

    monkeypatch.setattr(s, "surrogate", narrow)
    found = spark.createDataFrame([("email", f"v{i}") for i in range(30)], "kind string, value string")
    got = {r["value"]: r["surrogate"] for r in s.assign(found, b"k").collect()}
    assert len(got) == 30 == len(set(got.values())) and not set(got) & set(got.values())
    full = spark.createDataFrame([("email", f"v{i}") for i in range(61)], "kind string, value string")
    with pytest.raises(RuntimeError):
        s.assign(full, b"k", rounds=3)


def test_documents_keep_all_but_the_entities(documents):
    mail = "ann@example.org"
    rows = [(1, f"{mail} and 10.1.2.3"), (2, f"again {mail}!"), (2, f"again {mail}!"), (3, prose(1, 50)), (4, None), (5, ""),
            (None, mail), (6, "7 of 9 " * 20_000 + mail)]
    docs = documents(rows, extra=True)
    out = s.replace_entities(docs, b"k", count="n_found")
    assert out.columns == [*docs.columns, "n_found"]
    found = sorted(((r["doc_id"], r["text"], r["n_found"], r["score"]) for r in out.collect()), key=str)
    assert len(found) == len(rows) and all(r[3] == "x" for r in found)
    by_key = {r[0]: r for r in found}
    stand_in = by_key[None][1]
    assert stand_in != mail and by_key[2][1] == f"again {stand_in}!" and by_key[6][1].endswith(stand_in)
    assert by_key[1][2] == 2 and by_key[3][1:3] == (prose(1, 50), 0) and by_key[4][1] is None and by_key[5][1] == ""
    assert not any(mail in (r[1] or "") for r in found)
    assert s.replace_entities(documents([])).count() == 0


@pytest.mark.parametrize("text", ["٠١٢-٣٤٥-٦٧٨٩", "call ٠١٢-٣٤٥-٦٧٨٩ or 7", "٤١١١ ١١١١ ١١١١ ١١١١", "token = ०१२३४५६७८९०१२३४५६७"])
def test_digits_of_any_script_are_replaced_by_digits_of_it(documents, text):
    (row,) = s.replace_entities(documents([(1, text)]), b"k", count="n").collect()
    assert row["n"] == 1 and row["text"] != text and len(row["text"]) == len(text)
    for old, new in zip(text, row["text"]):
        assert (old == new) if not old.isdecimal() else ord(old) - int(old) == ord(new) - int(new)


def test_one_number_in_two_scripts_is_one_entity():
    assert kinds("٠١٢-٣٤٥-٦٧٨٩") == kinds("012-345-6789") == [("phone", "0123456789")]


@pytest.mark.parametrize("kind, value", [("phone", "+14995556503"), ("ip", "10.0.0.1"), ("card", "4111111111111111"),
                                         ("iban", "DE89370400440532013000")])
def test_numbered_stand_ins_are_of_the_form_and_distinct(kind, value):
    found = [s.numbered(kind, value, n) for n in range(500)]
    assert len(set(found)) == 500 and all(s.numbered(kind, f, 0) == found[0] for f in found)
    assert s.numbered(kind, value, 10 ** 40) is None
    if kind != "phone":
        assert all(kinds(f"x {f} y") == [(kind, f)] for f in found)


def test_entities_without_a_stand_in_after_the_rounds_get_unused_values(spark, monkeypatch):
    draw = s.surrogate
    monkeypatch.setattr(s, "surrogate", lambda kind, value, key, attempt=0: value if kind == "phone" else draw(kind, value, key, attempt))
    rows = [("phone", f"{n:010d}") for n in range(0, 60, 2)] + [("phone", "+4912345678"), ("email", "a@b.org")]
    got = {r["value"]: r["surrogate"] for r in s.assign(spark.createDataFrame(rows, "kind string, value string"), b"k", rounds=2).collect()}
    assert len(got) == 32 == len(set(got.values())) and not set(got) & set(got.values())
    assert all(len(v) == len(k) for k, v in got.items() if k != "a@b.org") and got["+4912345678"].startswith("+4")


def test_a_form_without_enough_unused_values_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(s, "surrogate", lambda kind, value, key, attempt=0: value)
    full = spark.createDataFrame([("phone", f"+1{n}") for n in range(10)], "kind string, value string")
    with pytest.raises(RuntimeError):
        s.assign(full, b"k", rounds=1)


@pytest.mark.parametrize("text, names", [
    ("Mr John Smith met Ann Lee. Smith left, John stayed; SMITH's car", ["John", "Smith", "Smith", "John", "Smith"]),
    ("Smith? Mr Smith's.", ["Smith", "Smith"]),
    ("Sir O'Neil. O'Neil's, O'Neils, Neil", ["O'Neil", "O'Neil"]),
    ("Frau Müller-Lüd. Müller-Lüd-led, Müller-Lüders, Hammersmith", ["Müller-Lüd", "Müller-Lüd"]),
    ("Госпожа Анна Иванова, ИВАНОВА", ["Анна", "Иванова", "Иванова"]),
    ("Ann Lee and John Smith", []),
])
def test_names_are_followed_through_their_text(text, names):
    found = s.mentions(text)
    assert [m.value for m in found] == names
    assert all(text[m.start:m.end] in (m.value, m.value.upper()) for m in found)


def test_a_whole_name_is_told_from_one_of_the_same_words():
    found = [m[:2] for m in s.mentions("Mr John Lee met Mrs Lee Ann. Lee Ann left, Lee stayed")]
    assert found[4:] == [("given_f", "Lee"), ("surname", "Ann"), ("surname", "Lee")]


def test_long_texts_and_long_words_take_time_in_proportion():
    for filler in ("a-" * 400_000, "mail me: " + "x@example.org " * 40_000, "Mr Smith " * 60_000):
        assert len(s.mentions("Mr Smith said " + filler)) >= 1


def of_gender(name, gender, script):
    return name in s.GIVEN[gender, script] or name.endswith(s.ENDINGS[gender, script])


@pytest.mark.parametrize("gender, script, value", [("m", "latin", "John"), ("f", "latin", "Ann"), ("m", "cyrillic", "Иван"),
                                                   ("f", "cyrillic", "Анна"), ("m", "greek", "Νίκος"), ("f", "greek", "Άννα")])
def test_given_names_keep_gender_and_script_at_any_attempt(gender, script, value):
    drawn = [s.surrogate(f"given_{gender}", value, b"k", attempt) for attempt in range(200)]
    assert all(of_gender(n, gender, script) and s._script(n) == script and n.istitle() for n in drawn)
    assert len(set(drawn)) > 150 and not any(of_gender(n, "mf"[gender == "m"], script) for n in drawn)


@pytest.mark.parametrize("value, ending", [("Иванова", "ова"), ("Иванов", "ов"), ("Andersson", "son"), ("Παπαδόπουλος", "ος")])
def test_surnames_keep_their_ending(value, ending):
    drawn = {s.surrogate("surname", value, b"k", attempt) for attempt in range(50)}
    assert len(drawn) == 50 and all(d.endswith(ending) and d.istitle() for d in drawn)


def test_more_given_names_than_the_lists_have_keep_gender_and_are_distinct(documents):
    names = [("".join(p), g) for g in "mf" for p in list(itertools.product("BDKLM", "aeiou", "nrst", "aeo"))[:250]]
    rows = [(i, f"{'Mr' if g == 'm' else 'Mrs'} {n}{g} Smith. {n}{g} left.") for i, (n, g) in enumerate(names)]
    out = {r["doc_id"]: r["text"] for r in s.replace_entities(documents(rows), b"k").collect()}
    new = {}
    for i, (_, g) in enumerate(names):
        match = re.fullmatch(r"(?:Mr|Mrs) (\w+) (\w+)\. (\w+) left\.", out[i])
        assert match[1] == match[3] and of_gender(match[1], g, "latin")
        new[i] = (g, match[1])
        assert match[2] == re.search(r" (\w+)\.", out[0])[1] != "Smith"
    assert len(set(new.values())) == 500


def test_documents_equal_texts_put_together_from_known_entities(documents):
    """Texts are dealt from literal words and spellings of known entities; what the pieces became must be one to one."""
    rng = random.Random(5)
    entities = {f"mail{i}": [f"u{i}@mail{i % 3}.example.com", f"U{i}@Mail{i % 3}.example.com"] for i in range(20)}
    entities |= {f"ip{i}": [f"10.1.{i}.7"] for i in range(20)}
    entities |= {f"phone{i}": [f"212-555-{1000 + i}", f"(212) 555-{1000 + i}"] for i in range(20)}
    texts, parts = [], []
    for key in range(120):
        pieces = []
        for _ in range(rng.randint(1, 12)):
            pieces.append((None, prose(rng.randint(0, 999), rng.randint(1, 4))))
            if rng.random() < 0.6:
                name = rng.choice(sorted(entities))
                pieces.append((name, rng.choice(entities[name])))
        pieces.append((None, "end"))
        texts.append((key, "|".join(p for _, p in pieces)))
        parts.append(pieces)
    out = {r["doc_id"]: r["text"] for r in s.replace_entities(documents(texts), b"k").collect()}
    became = {}
    for key, pieces in enumerate(parts):
        new = out[key].split("|")
        assert len(new) == len(pieces)
        for (name, old), now in zip(pieces, new):
            if name is None:
                assert now == old
            else:
                plain = now.lower() if name.startswith("mail") else re.sub(r"\D", "", now) if name.startswith("phone") else now
                assert became.setdefault(name, plain) == plain and re.sub(r"\w", "", now) == re.sub(r"\w", "", old)
    real = {v.lower() for spelled in entities.values() for v in spelled}
    assert len(set(became.values())) == len(became) and not set(became.values()) & real
