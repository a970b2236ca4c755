import random
import re

import pytest
from pyspark.sql import functions as F

from loanframe.llm.pii import _ENDINGS, _HINT, PATTERNS, draw_surrogates, replace_pii

#: A plain reading of the patterns whose values need no layout rules.
PLAIN = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}",
    "secret": r"\b[0-9a-f]{32,}\b",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])",
    "card": r"(?<!\d)\d{13,19}(?!\d)",
    "phone": r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}",
}


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in replace_pii(df, key).orderBy("doc_id").collect()]


def shape(text):
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", text)))


def test_types_keep_their_format(spark):
    texts = [
        "mail a.b-7@mail5.example.com, A.B-7@MAIL5.EXAMPLE.COM",
        "call +1 (743) 555-3824 or +1-743-555-3824 or 743-555-3824",
        "from 227.5.221.1 and 10.0.0.255, not 1.2.3.4.5 nor 999.1.1.1",
        "card 4111 1111 1111 1111 or 4111111111111111, order 9807915762804490",
        'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" password: "hunter22"',
        "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00 or DE89370400440532013000",
    ]
    out = run(spark, texts)
    assert all(shape(a) == shape(b) for a, b in zip(texts[:2], out[:2]))
    mails = re.findall(r"\S+@[\w.]+\w", out[0])
    assert mails[0].upper() == mails[1] and mails[0].endswith(".com") and mails[0] != "a.b-7@mail5.example.com"
    phones = re.findall(r"\+1[ \-(]+(\d{3})[) \-]+(\d{3})-(\d{4})", out[1])
    assert phones[0] == phones[1] and "".join(phones[0]) != "7435553824"
    ips = re.findall(PLAIN["ip"], out[2])
    assert len(set(ips)) == 3 and "999.1.1.1" in ips and "1.2.3.4.5" in out[2]
    assert all(0 < int(n) < 256 for ip in ips[:2] for n in ip.split("."))
    cards = [c.replace(" ", "") for c in re.findall(r"\d{4}(?: \d{4}){3}|\d{16}", out[3])]
    luhn = lambda n: sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(n[::-1])) % 10 == 0
    assert cards[0] == cards[1] and luhn(cards[0]) and not luhn(cards[2])
    assert re.fullmatch(r'token = "[0-9a-f]{40}" password: "[a-z]{6}\d\d"', out[4]) and "hunter" not in out[4]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} iban (DE\d\d(?: \d{4}){4} \d\d) or (DE\d{20})", out[5])
    assert "123-45-6789" not in out[5] and "3704 0044" not in out[5]


def test_persons_by_gender_script_and_coreference(spark):
    texts = [
        "Mrs. Anna Smith met Mr. Smith, Mr. John Smith and Dr. Anna Jones-Smith.",
        "Frau MÜLLER; г-жа Анна Петрова и господин Петрова",
        "Mr. Anna",
    ]
    a, b, c = run(spark, texts)
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+), Mr\. (\w+) (\w+) and Dr\. (\w+) (\w+)-(\w+)\.", a)
    anna, smith, smith2, john, smith3, anna2, jones, smith4 = m.groups()
    assert smith == smith2 == smith3 == smith4 and anna == anna2 and len({anna, smith, john, jones}) == 4
    assert anna.endswith(tuple(_ENDINGS["latin", "f"])) and john.endswith(tuple(_ENDINGS["latin", "m"]))
    assert not {"anna", "smith", "john", "jones"} & {x.lower() for x in m.groups()}
    m = re.fullmatch(r"Frau (\w+); г-жа (\w+) (\w+) и господин (\w+)", b)
    assert m[1].isupper() and m[3] == m[4] and re.fullmatch("[А-Яа-я]+", m[2] + m[3])
    assert c == f"Mr. {anna}"


def test_secrets_without_anything_to_draw_anew(spark):
    hidden = ["******", "пароль", "ΚΩΔΙΚΟΣ", "κωδικοι", "密码密码密码", "aaaaaa", "......", "111111", "a" * 6 + "1" * 40]
    out = run(spark, [f"password = \"{h}\"" for h in hidden])
    new = [re.fullmatch(r"password = \"([^\"]+)\"", t)[1] for t in out]
    assert len(set(new)) == len(new) and not set(new) & set(hidden)
    assert re.fullmatch(r"[а-я]{6}\w?", new[1]) and re.fullmatch(r"[Α-Ω]{7}\w?", new[2]) and re.fullmatch(r"\d{6}", new[7])


def test_a_format_without_room_is_an_error(spark, monkeypatch):
    monkeypatch.setattr("loanframe.llm.pii.MAX_DRAWS", 3)
    df = spark.createDataFrame([("ssn", str(i), "", "") for i in range(10)], "kind string, norm string, gender string, script string")
    with pytest.raises(ValueError, match="ssn"):
        draw_surrogates(df, "k")


def test_possessives_bare_names_and_spaced_phones(spark):
    texts = [
        "Mr. John Smith came. Later Smith said: Smith's car, JOHN, not Smithson; smith",
        "Mr. Smith's car and Ms. O'Brien, O'Brien’s hat; Mr. Smith'll go",
        "Smith and John here are other people; call 743 555 3824, not 1 743 555 3824 5",
    ]
    a, b, c = run(spark, texts)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) came\. Later (\w+) said: (\w+)'s car, ([A-Z]+), not Smithson; smith", a)
    john, smith = m[1], m[2]
    assert m[3] == m[4] == smith != "Smith" and m[5] == john.upper() != "JOHN"
    m = re.fullmatch(r"Mr\. (\w+)'s car and Ms\. (\w+), (\w+)’s hat; Mr\. (\w+)'ll go", b)
    assert m[1] == m[4] == smith and m[2] == m[3] != "O'Brien"
    assert re.fullmatch(r"Smith and John here are other people; call \d{3} \d{3} \d{4}, not 1 743 555 3824 5", c) and "call 743" not in c


def test_clashes_are_drawn_again(spark):
    # Six hundred names of one script and gender leave much fewer first draws.
    names = [("name", f"{a}{b}{c}", "n", "latin") for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz1234"]
    # 1000 values can be drawn, and none may be one of these.
    numbers = [("ssn", f"{i:03d}", "", "") for i in range(150)]
    df = spark.createDataFrame(names[:600] + numbers, "kind string, norm string, gender string, script string")
    rows = draw_surrogates(df, "k").collect()
    for kind, n in (("name", 600), ("ssn", 150)):
        cores = [r.core for r in rows if r.kind == kind]
        assert len(cores) == n == len(set(cores))
        assert not set(cores) & {r.norm for r in rows if r.kind == kind}
    again = {(r.kind, r.norm): r.core for r in draw_surrogates(df.repartition(7), "k").collect()}
    assert again == {(r.kind, r.norm): r.core for r in rows}
    other = {r.core for r in draw_surrogates(df, "another key").collect()}
    assert other != {r.core for r in rows}


def test_phones_of_one_country_stay_apart_and_together(spark):
    # 1500 of the 10,000 numbers +1 dd dd: their country's digits are no place to differ.
    r = random.Random(3)
    numbers = [f"{n:04d}" for n in r.sample(range(10_000), 1500)]
    texts = [f"+1 {n[:2]} {n[2:]}|+1{n}" for n in numbers]
    out = [t.split("|") for t in run(spark, texts)]
    assert all(re.fullmatch(r"\+1 \d\d \d\d", a) and a.replace(" ", "") == b for a, b in out)
    new = {b[2:] for _, b in out}
    assert len(new) == 1500 and not new & set(numbers)


def test_country_code_is_told_without_separators(spark):
    texts = ["+1 (743) 555-3824", "+17435553824", "+49 30 1234567", "+49301234567", "+380 44 123 4567", "+380441234567"]
    a, b, c, d, e, f = run(spark, texts)
    assert [shape(t) for t in texts] == [shape(t) for t in (a, b, c, d, e, f)]
    for spaced, plain, code in ((a, b, "+1"), (c, d, "+49"), (e, f, "+380")):
        assert re.sub(r"[ ()\-]", "", spaced) == plain and plain.startswith(code) and plain not in texts


def test_phones_that_run_out_get_longer(spark, monkeypatch):
    # All numbers +380 dd occur, so none of them can stand for another.
    monkeypatch.setattr("loanframe.llm.pii._PHONE_DRAWS", 1)
    out = run(spark, [f"+380{n:02d} and +380 {n // 10}{n % 10} 00" for n in range(100)])
    short = [t.split(" and ")[0] for t in out]
    assert len(set(short)) == 100 and all(re.fullmatch(r"\+380\d{3,}", t) for t in short)


def test_rows_nulls_and_other_columns(spark):
    hit = "mail x@y.org"
    rows = [(1, hit, "a"), (1, hit, "b"), (None, hit, "c"), (2, None, "d"), (3, "", "e"), (4, "no data", "f")]
    rows.append((5, "word " * 200_000 + "1.2.3.4", "g"))
    df = spark.createDataFrame(rows, "doc_id long, text string, N_ENTITIES string").withColumn("odd.name", F.lit(1))
    out = replace_pii(df, "k")
    assert out.columns == ["doc_id", "text", "odd.name", "n_entities"]
    got = {(r.doc_id, r.text and r.text[-30:], r.n_entities) for r in out.collect()}
    new = [t for i, t, n in got if i == 1]
    assert out.count() == 7 and len(new) == 1 and new[0] != hit and (None, new[0], 1) in got
    assert {(2, None, 0), (3, "", 0), (4, "no data", 0)} <= got
    assert replace_pii(df.filter("false"), "k").count() == 0
    with pytest.raises(ValueError):
        replace_pii(df, "")


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 300_000, "1" * 300_000, "a." * 150_000, "+1 " * 100_000, "Mr. " * 100_000, "f" * 300_000]
    assert run(spark, texts)[0] == texts[0]


def test_hint_holds_wherever_a_pattern_does(spark):
    r = random.Random(1)
    samples = ["a@b.cd", "gh" + "p_" + "A" * 36, "sk-" + "b" * 30, "Mr. Xy", "г-н Иванов", "secret='abcdefg'", "1.2.3.4"]
    texts = ["".join(r.choice([" ", "x", ".", *samples]) for _ in range(6)) for _ in range(200)]
    any_of = "|".join(f"(?:{p})" for p in PATTERNS.values())
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(F.col("t").rlike(any_of) & ~F.col("t").rlike(_HINT)).count() == 0


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    plan = replace_pii(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_equals_a_plain_search(spark):
    """On the given documents: the plain patterns find what was replaced, all of it, one
    to one over the whole table; everything else is as it was."""
    from loanframe.llm.queries import op4_pii_surrogates

    d = "/root/testdata/sf0.01"
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    after = {r.doc_id: r for r in op4_pii_surrogates(spark, d).collect()}
    assert before.keys() == after.keys()
    pattern = re.compile("|".join(f"(?:{p})" for p in PLAIN.values()))
    pairs = set()
    for i, text in before.items():
        old, new = pattern.findall(text), pattern.findall(after[i].text)
        assert len(old) == len(new) == after[i].n_entities, i
        assert pattern.split(text) == pattern.split(after[i].text)
        pairs |= set(zip(old, new))
    olds, news = {a for a, _ in pairs}, {b for _, b in pairs}
    assert len(pairs) == len(olds) == len(news) > 50 and not olds & news
