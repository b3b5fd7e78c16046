import re

import pytest
from pyspark.sql import functions as F

from eventframe.llm import pii
from eventframe.llm.queries import op9_pii_surrogates


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_ok(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


TEXT = (
    "Write to Ann.Lee99@mail7.example.com or call +1 (017) 555-7713, 212-555-0187. Card 4539 1488 0343 6467, not 4539148803436468. "
    "Host 97.51.17.173 not 999.1.1.1 or 1.2.3.4.5. SSN 078-05-1120. IBAN DE89 3704 0044 0532 0130 00 not DE00 3704 0044 0532 0130 00. "
    "Mr. John Smith met Frau Anna Müller and Dr Smith; г-жа Анна Петрова. Order 12345678, page 2024, token a@b."
)


@pytest.fixture(scope="module")
def rewritten(make_docs):
    return pii.pseudonymise(make_docs([(1, TEXT)]), "k").first()


def test_all_kinds_are_replaced(rewritten):
    for real in ("Ann.Lee99", "mail7", "555-7713", "555-0187", "4539 1488 0343 6467", "97.51.17.173", "078-05-1120", "3704 0044 0532 0130 00 not", "John", "Smith", "Anna", "Müller", "Анна", "Петрова"):
        assert real not in rewritten.text, real
    counts = {k: rewritten[f"entities_{k}"] for k in pii.KINDS}
    assert counts == {"email": 1, "iban": 1, "ssn": 1, "phone": 2, "card": 1, "ip": 1, "name": 4} and rewritten.n_entities == 11


def test_the_rest_stays(rewritten):
    for same in ("Write to ", "4539148803436468", "999.1.1.1", "1.2.3.4.5", "DE00 3704 0044 0532 0130 00", "Order 12345678, page 2024, token a@b.", "Mr. ", "Frau ", "Dr ", "г-жа "):
        assert same in rewritten.text, same


def test_format_gender_and_script(rewritten):
    t = rewritten.text
    assert re.search(r"Write to [A-Z][a-z]{2}\.[A-Z][a-z]{2}\d\d@[a-z\d]+\.example\.(com|net|org) or call \+1 \(\d{3}\) \d{3}-\d{4}, 2\d\d-\d{3}-\d{4}\.", t)
    card = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}),", t)[1]
    assert luhn(card.replace(" ", "")) and card[0] == "4"
    assert all(0 <= int(x) <= 255 for x in re.search(r"Host (\S+) not", t)[1].split("."))
    assert re.search(r"SSN \d{3}-\d{2}-\d{4}\.", t)
    iban = re.search(r"IBAN (DE\d\d(?: \d{4}){4} \d\d) not", t)[1]
    assert iban_ok(iban)
    first, last = re.search(r"Mr\. (\w+) (\w+) met", t).groups()
    assert any(first.endswith(e) for e in pii.ENDINGS["latin"]["m"])
    assert re.search(r"Dr (\w+);", t)[1] == last  # one person, two mentions
    assert any(re.search(r"Frau (\w+) \w+ and", t)[1].endswith(e) for e in pii.ENDINGS["latin"]["f"])
    her = re.search(r"г-жа ([А-Я][а-я]+) ([А-Я][а-я]+)\.", t)
    assert any(her[1].endswith(e) for e in pii.ENDINGS["cyrillic"]["f"])


def test_accented_addresses(make_docs):
    text = pii.pseudonymise(make_docs([(1, "an josé.pérez@correo.es, юрий@почта.рф.")]), "k").first().text
    assert "jos" not in text and "юрий" not in text and re.fullmatch(r"an [a-z]{4}\.[a-z]{5}@[a-z]+\.example\.\w{3}, [а-я]{4}@[а-яa-z]+\.example\.\w{3}\.", text), text


def test_coreference_distinctness_and_key(make_docs):
    mails = [f"u{k}@x.org" for k in range(200)]
    docs = make_docs([(k, f"{m} then {m.upper()} and {mails[0]}") for k, m in enumerate(mails)])
    rows = pii.pseudonymise(docs, "k").orderBy("doc_id").collect()
    made = [re.findall(r"\S+@\S+", r.text) for r in rows]
    assert all(a.lower() == b.lower() for a, b, _ in made) and len({c for _, _, c in made}) == 1
    assert len({a for a, _, _ in made}) == 200 and not {a for a, _, _ in made} & set(mails)
    other = pii.pseudonymise(docs, key="another").orderBy("doc_id").collect()
    assert all(a.text != b.text for a, b in zip(rows, other))
    assert [r.text for r in rows] == [r.text for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]


@pytest.mark.parametrize("broadcast", [20_000, 0])
def test_collisions_are_settled(make_docs, monkeypatch, broadcast):
    """Stand-ins from a space hardly larger than the number of entities, and one that is a real entity at first."""
    monkeypatch.setattr(pii, "BROADCAST_ROWS", broadcast)
    whole = pii.surrogate

    def narrow(key, kind, norm, attempt):
        number = F.conv(F.substr(pii.secret(key, kind, norm, attempt), F.lit(1), F.lit(8)), 16, 10).cast("long") % 64
        return F.when(kind == "email", F.concat(F.lit("e"), number.cast("string"), F.lit("@q.org"))).otherwise(whole(key, kind, norm, attempt))

    monkeypatch.setattr(pii, "surrogate", narrow)
    mails = [f"e{k}@q.org" for k in range(0, 64, 4)] + [f"m{k}@q.org" for k in range(14)]
    docs = make_docs([(k, f"mail {m} and {mails[0]}, no more") for k, m in enumerate(mails)] + [(99, None), (100, ""), (101, "none")])
    rows = {r.doc_id: r.text for r in pii.pseudonymise(docs, "k").collect()}
    made = {k: re.findall(r"e\d+@q\.org", rows[k]) for k in range(len(mails))}
    assert all(len(v) == 2 for v in made.values())
    assert len({v[0] for v in made.values()}) == len(mails) and {v[1] for v in made.values()} == {made[0][0]}
    assert not {v[0] for v in made.values()} & set(mails)
    assert rows[99] is None and rows[100] == "" and rows[101] == "none"
    assert all(re.fullmatch(r"mail \S+ and \S+, no more", rows[k]) for k in range(len(mails)))


def test_query_against_plain_patterns(spark, sf):
    """Detection once more, by patterns of their own for what the table holds: each such mention is replaced by one of its shape,
    mentions of one entity alike, and nothing else is touched."""
    own = re.compile(r"[^\W_][\w.]*@(?:[a-z0-9]+\.)+[a-z]+|\+\d \(\d{3}\) \d{3}-\d{4}|(?<![\w.-])\d{16}(?![\w-])|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])|(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_pii_surrogates(spark, sf).collect()
    assert len(rows) == len(docs)
    seen: dict[str, str] = {}
    for r in rows:
        at = end = 0
        for m in own.finditer(docs[r.doc_id]):
            gap = docs[r.doc_id][end : m.start()]
            assert r.text.startswith(gap, at)
            at, end = at + len(gap), m.end()
            if re.fullmatch(r"\d{16}", m[0]) and not luhn(m[0]):
                assert r.text.startswith(m[0], at)
                at += len(m[0])
                continue
            new = own.match(r.text, at)
            assert new and new[0] != m[0] and (("@" in m[0]) == ("@" in new[0])), m[0]
            assert "@" in m[0] or "." in m[0] or re.sub(r"\d", "0", m[0]) == re.sub(r"\d", "0", new[0])
            assert not re.fullmatch(r"\d{16}", m[0]) or luhn(new[0])
            assert seen.setdefault(m[0].lower(), new[0].lower()) == new[0].lower()
            at = new.end()
        assert r.text[at:] == docs[r.doc_id][end:]
    assert len(seen) > 10 and len(set(seen.values())) == len(seen) and not set(seen) & set(seen.values())


NAMES = (
    "Dr. Anna Schmidt and Frau Anna Schmidt; Anna Schmidt wrote, says Yesterday Anna Schmidt Today. Mr. O'Neil, Frau von Berg, Mr. JOHN SMITH and Mr. John Smith's car. "
    "Mrs. Smith-Jones met Dr. Maria de la Cruz. Maria de la Cruz left. Ann Lee stays, Ann.Lee@X.org goes; Anna Berg stays."
)


@pytest.mark.parametrize("broadcast", [20_000, 0])
def test_names(make_docs, monkeypatch, broadcast):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", broadcast)
    t = pii.pseudonymise(make_docs([(1, NAMES)]), "k").first().text
    shape = re.fullmatch(
        r"Dr\. (?P<a>\w+) (?P<s>\w+) and Frau (?P=a) (?P=s); (?P=a) (?P=s) wrote, says Yesterday (?P=a) (?P=s) Today\. Mr\. O'(?P<o>\w+), Frau von (?P<b>\w+), Mr\. (?P<J>\w+) (?P<M>\w+) and Mr\. (?P<j>\w+) (?P<m>\w+)'s car\. "
        r"Mrs\. (?P=m)-(?P<n>\w+) met Dr\. (?P<r>\w+) de la (?P<c>\w+)\. (?P=r) de la (?P=c) left\. Ann Lee stays, (?P<e>[\w.]+)@[\w.]+ goes; Anna Berg stays\.", t)
    assert shape, t
    g = shape.groupdict()
    assert g["J"] == g["j"].upper() and g["M"] == g["m"].upper() and re.fullmatch("[A-Z][a-z]{2}[.][A-Z][a-z]{2}", g["e"])
    assert not {x.lower() for x in g.values()} & set("anna schmidt neil berg john smith jones maria cruz".split())
    assert any(g["a"].endswith(x) for x in pii.ENDINGS["latin"]["f"]) and any(g["r"].endswith(x) for x in pii.ENDINGS["latin"]["n"])


def test_addresses_of_version_six(make_docs):
    texts = ["at 2001:db8:85a3:8:1319:8a2e:370:7344 now", "at FE80::1FF:FE23:4567 now", "std::vector add::bed 12:30:45 a::b"]
    got = [r.text for r in pii.pseudonymise(make_docs(list(enumerate(texts))), "k").orderBy("doc_id").collect()]
    assert got[2] == texts[2] and all(a != b and re.sub("[0-9a-fA-F]", "0", a) == re.sub("[0-9a-fA-F]", "0", b) for a, b in zip(got[:2], texts)) and got[1] == got[1].replace("at", "AT").replace("now", "NOW").upper().replace("AT ", "at ").replace(" NOW", " now")


def test_a_key_is_needed(make_docs):
    with pytest.raises(TypeError):
        pii.pseudonymise(make_docs([(1, TEXT)]))
    with pytest.raises(ValueError):
        pii.pseudonymise(make_docs([(1, TEXT)]), "")


def test_plan_is_native(make_docs):
    plan = pii.pseudonymise(make_docs([(1, TEXT)]), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd_docs, clashing):
    rows = pii.pseudonymise(clashing(odd_docs).withColumn("n_entities", F.lit("old")), "k").collect()
    assert len(rows) == odd_docs.count()
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in odd_docs.collect()) and all(r.n_entities == 0 for r in rows if r.text is not None)
    assert pii.pseudonymise(odd_docs.limit(0), "k").collect() == []


def test_long_runs_take_linear_time(make_docs):
    import time

    t = time.time()
    texts = ["a" * 200_000, "1" * 200_000, "1 " * 100_000, "a." * 100_000, "+1" * 100_000, "Mr A" * 50_000, "a@" * 100_000, "1." * 100_000, "AB12" * 50_000]
    assert pii.pseudonymise(make_docs(list(enumerate(texts))), "k").agg(F.sum(F.length("text"))).first()[0]
    assert time.time() - t < 60


def test_phone_layouts(make_docs):
    phones = ["+14155550123", "+49 30 1234567", "+49 151 23456789", "+33 1 23 45 67 89", "555 123 4567", "(030) 123456", "+1 (017) 555-7713", "030 1234567", "01 23 45 67 89", "(415) 555-0123"]
    rows = pii.pseudonymise(make_docs([(k, f"Call {p} or {p}, now.") for k, p in enumerate(phones)]), "k").collect()
    for r in rows:
        assert r.entities_phone == 2 and phones[r.doc_id] not in r.text, r.text
        assert re.sub(r"\d", "0", r.text) == re.sub(r"\d", "0", f"Call {phones[r.doc_id]} or {phones[r.doc_id]}, now.")
    same = ["+1 23", "+1234567890123456", "in 2024 100 200", "01.02.2024", "4539148803436468"]
    assert [r.text for r in pii.pseudonymise(make_docs(list(enumerate(same))), "k").orderBy("doc_id").collect()] == same
    after = pii.pseudonymise(make_docs([(1, "+14155550123 20240501")]), "k").first()
    assert after.entities_phone == 1 and after.text.endswith(" 20240501")


def test_other_cased_scripts_get_stand_ins(make_docs):
    units = make_docs([(1, "Dr. Արամ"), (2, "Dr. Ⲁⲃⲅ")]).selectExpr("text AS e")
    made = {r.norm: r.made for r in pii.entity_table(units, "k", rounds=3).collect()}
    assert set(made) == {"արամ", "ⲁⲃⲅ"} and not set(made) & set(made.values())
    assert re.fullmatch("[ա-ֆ]{4}", made["արամ"])


def test_session_key(spark, caplog):
    """Without the setting a session makes up a key and keeps it."""
    spark.conf.unset(pii.KEY)
    first = pii.session_key(spark)
    assert len(first) == 64 and pii.session_key(spark) == first and "not set" in caplog.text
    spark.conf.set(pii.KEY, "own")
    assert pii.session_key(spark) == "own"
    spark.conf.unset(pii.KEY)
    assert pii.session_key(spark) != first
    spark.conf.unset(pii.KEY)
