"""Sentence ends among markup, in several scripts."""

import pytest

from linkloom.llm.sentences import Judge, Model, learn, mask, sentences, units, word_before


def judge(**k):
    own = Model(abbreviations=set(k.get("abbr", ())), ending=set(k.get("ending", ())), starters=set(k.get("starters", ())), small=set(k.get("small", ())), common=set(k.get("common", ())), follows=set(k.get("follows", ())))
    return Judge.of(own, [own])


def split(text, **k):
    """Sentences as marked by '|' in expected texts."""
    out, at = "", 0
    for e in judge(**k).ends(text, mask(text)):
        out += text[at:e] + "|"
        at = e
    return out + text[at:]


EN = {"abbr": {"Dr", "vs", "Prof", "approx", "cf", "c", "etc", "St", "U.S", "Co", "Sr"}, "starters": {"The", "It", "We"}, "common": {"His"}}
CASES = [
    ("He saw Dr. Bell vs. Prof. Hall.| It ended.|", EN),
    ("It cost approx. 3.5 m. for him.| The end.|", EN),
    ('"We won!" said he.| "It is done."| With that he left.|', EN),
    ("Sold to Bell & Co.| The owners (see p. 4. Also 5.) left.<ref>A. B. (1.)</ref>| It was 3:1!{{cn|x}}| Why?!|", EN),
    ("By the U.S. Consul.| Held by Bell Sr.| His widow left ... others not.|", EN),
    ("No mark at the end|\n\n* item one|\n* item two|\n", EN),
    ("== Head. Line ==\nText goes\non here.| Next.|\n{| class=x\n| a. B\n|}\n[[Category:X. Y]]\n{{stub}}\n<!-- A. B -->\n", EN),
    ("#REDIRECT [[Somewhere. Else]]\n", {}),
    ("Link [[a. B|to bee]].| '''Bold''' text.|", EN),
    ("« C’est fini ! » cria Paul.| « Quoi ? »| Personne.|", {}),
    ("„Nein!“, rief er.| »Gut.«| So ging es.|", {}),
    ("Am 3. Juli kam er.| Ende 1771.| Die Zeit.|", {"ending": {"#4"}, "starters": {"Die"}}),
    ("он ушёл.| школа закрыта.| «Кто?» — спросил он.| Да…| Нет.|", {"small": {"школа"}}),
    ("他说：“走。来。”|真的吗？|“好。”他说道。|（第2卷。1872年）在。|", {}),
    ("「行こう！」と話した。|本当か？と書く。|「完成した。」|これが最後だ。|", {}),
    ("वह गया।| “बस। चलो।” उसने कहा।|", {}),
    ("Ποιος ήρθε;| Κανείς.|", {}),
    ("ናና መጣ።| የት አለ፧| «ነው።» አለ ሲሲ።|", {}),
    ("بنى د. مودو.| من بنى؟| لا أحد.|", {"abbr": {"د"}, "starters": {"من"}}),
    ("'Is that all?' wondered he; it was.| Who reads this? 🤡|", EN),
    ("It ended in town.|The man left.| See plan.txt and a.b.c here.|", {"starters": {"The"}}),
    ("これは終わり．|次は3．5である．|", {}),
    ("ตลาดปิด 17.30 น. ของวัน| ใครซื้อตลาด?| Qui a vu le verger ?| Personne à Wiltav.| ตลาดเปิด|", {"follows": {"ของ", "น."}}),
    ("Line one.|\r\n\r\nLine two.|​\r\n", {}),
]


@pytest.mark.parametrize("marked,model", CASES)
def test_marks(marked, model):
    assert split(marked.replace("|", "") if "[[" not in marked and "{" not in marked else _unmark(marked), **model) == marked


def _unmark(marked):
    """Removes the marks, which stand at the end of a line or before a space, and leaves the pipes of markup."""
    import re

    return re.sub(r"(?<=[.!?}>])\|(?=\s|$)|(?<=[a-z])\|(?=\n|$)", "", marked)


@pytest.mark.parametrize("text", ["", " ", "\n\n", "{{", "[[[[ ]]", "}}}} |- |} [[", "</div></ref>", "<nowiki><br>", "== x ==", "----", "__NOTOC__ <!-- x -->", "{{{1|A. B}}}", "[[de:X]]\n[[File:a.jpg|A. B]]"])
def test_no_sentence(text):
    assert judge().ends(text, mask(text)) == []


def test_mask_keeps_length():
    for t in ("a<!-- x", "[[a|b]] {{c}} <ref>d</ref> '''e''' __TOC__ &nbsp;", "\r\n­{{a{{b}}c}}"):
        assert len(mask(t)) == len(t)
        for a, b in units(t, mask(t)):
            assert 0 <= a < b <= len(t)


def test_table_cases(spark):
    long = "Word goes on. " * 20000
    rows = [(1, "en", None, 1), (2, None, "", 1), (3, "en", "One. Two!", 2), (3, "en", "One. Two!", 2), (4, "??", "  \n", None), (5, "EN", long, None), (None, "en", "No id.", 3)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, page_id long").selectExpr("*", "'x' AS sent_end")
    got = [(r.doc_id, r.sent_end) for r in sentences(df).collect()]
    assert sorted(e for d, e in got if d == 3) == [4, 4, 9, 9]
    assert sum(d == 5 for d, _ in got) == 20000 and {d for d, _ in got} == {3, 5, None}
    assert sentences(df.limit(0)).count() == 0


def test_abbreviations_are_learned(spark):
    names = ["Abel", "Bert", "Carl", "Dora", "Emil", "Fred", "Gerd", "Hans", "Ivan", "Jane"] * 6
    text = "He met Zrof. {n} in town. It rained on {n}. Then {n} left the town.\n\nIt is a town where Zrof. {n} slept.\n\nThen came {n}."
    rows = [(i, "en", text.format(n=n), i) for i, n in enumerate(names)]
    got = sorted(r.sent_end for r in sentences(spark.createDataFrame(rows, "doc_id long, lang string, text string, page_id long")).where("doc_id = 0").collect())
    t = rows[0][2]
    want = [t.index("town.") + 5, t.index("Abel. Then") + 5, t.index("the town.") + 9, t.index("slept.") + 6, len(t)]
    assert got == want


def test_no_length_is_too_long():
    ref = "<ref>" + "A. B. " * 900 + "</ref>"
    nested = "{{a|" * 9 + "x. Y" + "}}" * 9
    tag = '<span title="' + "t. T " * 100 + '">'
    long = "w" * 70
    text = f"One ends.{ref} Two {tag}ends.</span> {nested}Three by {long}. Four said “" + "x" * 400 + "!” he. End."
    want = ["One ends." + ref, f"Two {tag}ends.</span>", f"{nested}Three by {long}.", "Four said “" + "x" * 400 + "!” he.", "End."]
    ends = judge().ends(text, mask(text))
    got = [text[a:b].strip() for a, b in zip([0, *ends], ends)]
    assert got[0] == want[0] and got[-3:] == want[-3:] and "".join(text[a:b] for a, b in zip([0, *ends], ends)) == text
    assert word_before(f"by {long}.", 0, 3 + len(long)) == long
    assert mask("<ref>" * 3000).count("<") == 0 and len(mask("<ref>" * 3000)) == 15000


def test_collocations():
    text = "He met Prof. Adam there. The 1. Auflage came."
    plain = Model(abbreviations={"Prof"}, common={"Adam"}, together={"Prof\tAdam"})
    assert Judge.of(plain, [plain]).ends(text, mask(text))[0] == len("He met Prof. Adam there.")
    without = Model(abbreviations={"Prof"}, common={"Adam"})
    assert Judge.of(without, [without]).ends(text, mask(text))[0] == len("He met Prof.")


def test_a_language_can_deny_what_others_say():
    other = Model(abbreviations={"so"}, starters={"Die"})
    text = "It was so. Die was cast by Co. Die it is."
    free, denying = Model(), Model(denied={"abbreviations": {"so"}})
    assert Judge.of(denying, [other, denying]).ends(text, mask(text))[0] == len("It was so.")
    assert "so" in Judge.of(free, [other, free]).abbreviations and "so" not in Judge.of(denying, [other, denying]).abbreviations


def test_repeated_paragraphs_count_as_often_as_they_occur(spark):
    names = ["Abel", "Bert", "Carl", "Dora", "Emil", "Fred", "Gerd", "Hans"]
    rows = [(i, "en", f"He met Zrof. {n} in town. It rained.\n\nThen {n} left Zrof. {n} there.", i) for i, n in enumerate(names * 6)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, page_id long")
    from linkloom.runtime import Scratch

    a, b = (learn(df.repartition(k), Scratch(spark, "learn"))["en"] for k in (1, 5))
    assert a == b and "Zrof" in a.abbreviations and "Then" in a.starters
