import hashlib
import random
import re

from roadcast.llm.pii import base_spans, find_pii, luhn, sanitise

from .helpers import docs, odd_rows, table

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(CARD, text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_spans_equal_the_patterns():
    parts = ["a", "b.", "@", "@x", ".de", "-", "+49", " 030", "1.2.3.4", "999", "4111 1111 1111 1111", "(0)", "é", "\n", ".", "255.0.0.255"]
    for x in range(3000):
        r = random.Random(x)
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))
        assert base_spans(text) == brute(text), text


def test_driver_table(spark):
    t = table(spark, sf="/root/testdata/sf0.01")
    text = {r["doc_id"]: r["text"] or "" for r in t.collect()}
    got = find_pii(t).collect()
    assert len(got) == len(text)
    kinds = ["email", "ip", "card", "phone"]
    for r in got:
        want = brute(text[r["doc_id"]])
        s = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(s.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(w[1] == i for w in want) for i in range(4)]
        assert set(filter(None, s.split(","))) <= set(r["spans"].split(","))
        if not want:
            assert r["spans"] == ""              # nothing is added where nothing is protected


def test_revealing_terms(spark):
    rng = random.Random(1)
    plain = ["the", "house", "green", "runs", "often", "river", "table", "walk"]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 40 == 0:                           # always beside this value, nowhere else
            words[10:10] = ["Zorblat", "boss@corp.example.com", "mayor" if i % 80 else "river"]
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r for r in find_pii(docs(spark, rows)).collect()}
    for i, text in rows:
        shown = {text[s["start"]:s["end"]] for s in got[i]["found"] if s["kind"] in ("term", "hint")}
        assert shown <= {"Zorblat", "mayor"}
        assert ("Zorblat" in shown) == (i % 40 == 0)
        if i % 40 == 0:
            clean = sanitise(text, got[i]["found"])
            assert "Zorblat" not in clean and "boss@" not in clean and "[EMAIL]" in clean


def test_copies_do_not_make_words_revealing(spark):
    rows = [(i, "unique words standing near me@one.example.org here") for i in range(50)]
    rows += [(100 + i, f"other text number {i}") for i in range(50)]
    assert all("term" not in r["spans"] and "hint" not in r["spans"] for r in find_pii(docs(spark, rows)).collect())


def test_odd_rows(spark):
    got = find_pii(docs(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got)
    assert find_pii(docs(spark, [])).count() == 0


def test_long_runs_of_digits_take_linear_time():
    import time

    start = time.perf_counter()
    for text in ("7" * 1_000_000 + ".", ("1" * 50 + ".") * 20_000, "1.2." * 250_000, "." + "9" * 1_000_000 + ".1.1." + "2" * 1_000_000):
        got = [s for s in base_spans(text) if s[1] == 1]
        assert all(text[a:b].count(".") == 3 for a, _, b in got)
    assert time.perf_counter() - start < 20
