import random

from roadcast.llm.pii import find_pii, sanitise

from .helpers import docs


def test_terms_of_rare_values_are_told_and_marked_everywhere(spark):
    rng = random.Random(6)
    plain = ["the", "house", "green", "runs", "often", "river", "table", "walk"]

    def words(n):
        return [rng.choice(plain) for _ in range(n)]
    rows = [(i, " ".join(words(30))) for i in range(400)]
    far = ["Quendrix", *words(20)]                     # again outside the window
    rows[10] = (10, " ".join(words(20) + ["Quendrix", "solo@one.example.com"] + words(20) + far))
    for i in (20, 21):                                 # two contexts; in 22 the term stands only far away
        rows[i] = (i, " ".join(words(20) + ["Morvath", "pair@two.example.com"] + words(20)))
    rows[22] = (22, " ".join(["Morvath", *words(20), "pair@two.example.com", *words(20)]))
    got = {r["doc_id"]: r["found"] for r in find_pii(docs(spark, rows)).collect()}
    for i, text in rows:
        shown = [text[s["start"]:s["end"]] for s in got[i] if s["kind"] in ("term", "hint")]
        assert shown == {10: ["Quendrix"] * 2, 20: ["Morvath"], 21: ["Morvath"], 22: ["Morvath"]}.get(i, [])
        assert i not in (10, 20, 21, 22) or not {"Quendrix", "Morvath"} & set(sanitise(text, got[i]).split())


def test_common_words_at_one_context_are_chance(spark):
    rows = [(i, f"word{i % 20} stands here") for i in range(200)]
    rows.append((500, "word3 me@one.example.org word5"))
    assert all("term" not in r["spans"] and "hint" not in r["spans"] for r in find_pii(docs(spark, rows)).collect())
