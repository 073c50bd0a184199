"""Sentences of wiki texts in many languages and scripts.

Two passes over all documents.  The first counts, per language, words with and without a period, what
follows a period, and what starts and ends paragraphs; log-likelihood ratios of these counts tell abbreviations,
collocations around a period, and sentence starters, without any list of them.  The second finds paragraphs and list
items among the markup and classifies each mark of punctuation with the statistics of the document's language, and of
others for words that are rare in it, since texts quote other languages and some are declared wrongly: marks that end sentences in their script do; a period behind an abbreviation, a number or dots does only if what follows
starts sentences and is no collocation with it; what stands in quotation marks or brackets stays with its sentence.

Revisions repeat most of their paragraphs: each different paragraph is counted and classified once a batch, with its number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.runtime import Scratch

# Masks, as long as what they hide: a note or template (part of the text), markup within words, what is no text.
NOTE, MARK, VOID = "\x01", "\x02", "\x03"
LEAST = 4  #: periods behind a word before it can be an abbreviation
TOGETHER = 7.88  #: the same of a collocation (one in two hundred)
SHARE = 2e-6  #: of a language's events of a kind, the least a learned word has, so that a language has 1 / SHARE of a kind at most
OFTEN = 40  #: occurrences from which a language can deny what others say of a word
CACHE = 20_000_000  #: letters of paragraphs a worker remembers at once; it forgets all when they are reached
STARTS = 10.8  #: log-likelihood ratio of a sentence starter (one in a thousand by chance)


def _fill(c: str):
    return lambda m: c * (m.end() - m.start())


def _fill_text(m: re.Match) -> str:
    """Hides a link's target and its brackets, and leaves its words."""
    target = m.group(1)
    return MARK * (2 + len(target)) + m.group(2) + MARK * 2


_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REF = re.compile(r"<ref\b[^<>]*/>|<ref\b[^<>]*>(?:[^<]|<(?!/?ref\b))*</ref>", re.S)
_TEMPLATE = re.compile(r"\{\{\{[^{}]*\}\}\}|\{\{[^{}]*\}\}")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]*>")
_NAMESPACE = re.compile(r"\[\[:?[^\[\]|:\n]+:(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]")
_LINK = re.compile(r"\[\[((?:[^\[\]|]*\|)?)([^\[\]|]*)\]\]")
_QUOTES = re.compile(r"'{2,5}")
_SWITCH = re.compile(r"__[A-Z]{3,}__")
_HIDDEN = re.compile("[​‌‎‏­﻿⁠᠎]")


def mask(text: str) -> str:
    """The text with markup hidden, character by character."""
    t = text.replace("\r\n", " \n").replace("\r", "\n") if "\r" in text else text
    t = _HIDDEN.sub(VOID, t)
    if "<" in t:
        t = _COMMENT.sub(_fill(VOID), t)
        t = _REF.sub(_fill(NOTE), t)
    if "{{" in t:
        n = 1
        while n:
            t, n = _TEMPLATE.subn(_fill(NOTE), t)
    if "[[" in t:
        t = _NAMESPACE.sub(_fill(VOID), t)
        t = _LINK.sub(_fill_text, t)
    if "<" in t:
        t = _TAG.sub(_fill(MARK), t)
    if "''" in t:
        t = _QUOTES.sub(_fill(MARK), t)
    if "__" in t:
        t = _SWITCH.sub(_fill(VOID), t)
    if "&nbsp;" in t:
        t = t.replace("&nbsp;", "      ")
    return t


_LINE = re.compile(r"[^\n]*\n|[^\n]+\Z")
_SKIP = re.compile(r"[\s\x02\x03]*(?:={1,6}.*={1,6}[\s\x01\x02\x03]*$|\{\||\||!.*!!|\}\}|\{\{|-{4,}|#\s?[^\W\d_]+:?\s*\x02)")
_REDIRECT = re.compile(r"\s*#\s?[^\W\d_]+[^\w\[]*:?\s*\[\[[^\]\n]*\]\][^\w]*$")
_ITEM = re.compile(r"[\s\x03]*[*#:;]+")
_LETTER = re.compile(r"[^\W\d_]")
_SPOKEN = re.compile(r"[^\W_]")
_EMPTY = re.compile(r"[\s\x01\x02\x03]*$")


def units(text: str, m: str) -> list[tuple[int, int]]:
    """Paragraphs and list items: where the text of each begins and ends in the mask."""
    out: list[tuple[int, int]] = []
    start = end = -1

    def close() -> None:
        if start >= 0 and end > start and _LETTER.search(m, start, end):
            out.append((start, end))

    b = 0
    for s in m.splitlines(keepends=True) if "\x0b" not in m and "\x0c" not in m and "\x1c" not in m else _LINE.findall(m):
        a, b = b, b + len(s)
        head = s.lstrip()[:1]
        if not head or head == "|":
            close()
            start = -1
            continue
        if head in NOTE + MARK + VOID and _EMPTY.match(s):
            # Templates, comments and links alone on a line: no text, but a paragraph may go on behind a comment.
            if NOTE in s or VOID in s:
                close()
                start = -1
            continue
        if head in MARK + VOID:
            head = s.lstrip(" \t\x02\x03\xa0")[:1]
        if head and head in "={|!}-#" and (_SKIP.match(s) or head == "#" and _REDIRECT.match(text[a:b])):
            close()
            start = -1
            continue
        item = _ITEM.match(s) if head in "*#:;" else None
        if item:
            close()
            start = a + item.end()
        elif start < 0:
            start = a
        end = b
    close()
    trimmed = []
    for a, b in out:
        while a < b and (m[a].isspace() or m[a] == VOID):
            a += 1
        while b > a and (m[b - 1].isspace() or m[b - 1] == VOID):
            b -= 1
        if b > a:
            trimmed.append((a, b))
    return trimmed


# Marks of sentence ends by script, and of quotations.
STOPS = ".!?…。！？｡．।॥።፧։؟۔"
SURE = set("!?。！？｡．।॥።፧։؟۔")
_STOP = re.compile(rf"[{STOPS}]+|;(?=[\s\x02\x03]|$)|;")
OPEN = "“„«‚‘「『《〈（([{‹"
CLOSE = {"“": "”", "„": "“”", "«": "»", "‚": "‘’", "‘": "’", "「": "」", "『": "』", "《": "》", "〈": "〉", "（": "）", "(": ")", "[": "]", "{": "}", "‹": "›", "»": "«"}
CLOSERS = "”»’」』》〉）)]›\"'"
_CLOSED = re.compile("[\"'”’»」』›]")
_PAIRED = re.compile("[\"“”„«»‚‘’「」『』《》（）()]")
QUOTE_SIGNS = set("“”„«»‚‘’「」『』\"")
_AROUND = ".'’-—–\"“”„«»‚‘()[]{}/,;:!?…（）「」《》" + NOTE
# Letters of all scripts with the signs that belong to them, as one class.
_LETTERS = (
    "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u037d\u037f-\u0386\u0388-\u0482\u0484-\u0559\u0560-\u0588\u0591-\u05bd\u05d0-\u05f2"
    "\u0610-\u061a\u0620-\u065f\u066e-\u06d3\u06d5-\u06ef\u06fa-\u06ff\u0710-\u0963\u0971-\u0e3a\u0e40-\u0e4e\u0e81-\u1360\u1380-\u1fff"
    "\u2c00-\u2dff\u3005-\u3007\u3031-\u309f\u30a1-\u30fa\u30fc-\u9fff\ua4d0-\ud7a3\uf900-\ufdff\uff21-\uff3a\uff41-\uff5a\uff66-\uffdc\U00010000-\U0001efff\U00020000-\U0003ffff"
)
_NEXT = re.compile(rf"[\s\x02\x03]*(?P<open>[\"“„«»‚‘'(\[（「『《¿¡\x02\x03]*)\s?(?P<word>(?:[0-9{_LETTERS}]+|.)?)", re.S)
_THAI = re.compile("[฀-๿]")
_GREEK = re.compile("[Ͱ-Ͽἀ-῿]")
_CJK = re.compile("[぀-ヿ㐀-鿿]")
_CASED = re.compile(r"[A-Za-zÀ-ɏͰ-ϿЀ-ӿԱ-֏]")
#: Verbs of saying and words that lead on, for scripts without capitals.
SAYING = re.compile("说|道|问|喊|答|叫|讲|कहा|पूछा|बोल|बताया|አለ|አሉ|قال|سأل|صاح|述べ|言")
LEADING_ON = re.compile("随后|然后|便|就|并|而|और|तो|と|って|など|という|، |و")
#: Fixed value: the Japanese particle behind reported words, not as the beginning of a word.
_REPORTED = re.compile("(?:と(?!て|こ|き|り|も|に)|って)")


def enclosed(m: str, a: int, b: int) -> list[tuple[int, int, bool]]:
    """Outermost spans in quotation marks (True) or brackets between a and b; unpaired marks open nothing."""
    spans: list[tuple[int, int, bool]] = []
    stack: list[tuple[str, int]] = []
    for x in _PAIRED.finditer(m, a, b):
        ch, i = x.group(), x.start()
        if stack and ch in CLOSE.get(stack[-1][0], "") and not (ch == "’" and i + 1 < b and m[i + 1].isalpha()):
            o, at = stack.pop()
            if not stack:
                spans.append((at, i + 1, o in QUOTE_SIGNS))
        elif ch == '"':
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if at is None:
                stack.append((ch, i))
            else:
                start = stack[at][1]
                del stack[at:]
                if not stack:
                    spans.append((start, i + 1, True))
        elif ch in CLOSE and not (ch == "‘" and i and m[i - 1].isalpha()):
            if ch == "»" and stack and any(o == "«" for o, _ in stack):
                while stack and stack[-1][0] != "«":
                    stack.pop()
                o, at = stack.pop()
                if not stack:
                    spans.append((at, i + 1, True))
            elif ch != "«" or not any(o == "»" for o, _ in stack):
                stack.append((ch, i))
        elif stack and any(ch in CLOSE.get(o, "") for o, _ in stack) and ch != "’":
            while ch not in CLOSE.get(stack[-1][0], ""):
                stack.pop()
            o, at = stack.pop()
            if not stack:
                spans.append((at, i + 1, o in QUOTE_SIGNS))
    return spans


@dataclass
class Model:
    """What the first pass learned of one language."""

    abbreviations: set[str] = field(default_factory=set)  #: words whose period belongs to them
    ending: set[str] = field(default_factory=set)  #: of these and the numbers, those that end sentences too
    starters: set[str] = field(default_factory=set)  #: words that start sentences
    small: set[str] = field(default_factory=set)  #: words written small that are seen at starts of paragraphs
    common: set[str] = field(default_factory=set)  #: words that are written small elsewhere
    follows: set[str] = field(default_factory=set)  #: beginnings of phrases behind spaces (Thai) or dots (Chinese, Japanese) that never start a paragraph
    together: set[str] = field(default_factory=set)  #: collocations: a word with a period and the word behind it, a tab between
    denied: dict[str, set[str]] = field(default_factory=dict)  #: by kind, words that are of it in another language and plainly not in this one


KINDS = ("abbreviations", "ending", "starters", "small", "common", "follows", "together")


def word_type(w: str) -> str:
    """A word, or of a number the number of its digits."""
    return f"#{min(len(w), 4)}" if w.isdigit() else w


def word_before(m: str, a: int, i: int) -> str:
    """The word, with periods inside it, that ends at i."""
    if i == a or m[i - 1].isspace():
        return ""
    look = 24
    while True:
        start = max(a, i - look)
        w = m[start:i].split()[-1]
        if start == a or len(w) < i - start:
            break
        look *= 4
    if MARK in w or VOID in w:
        w = w.replace(MARK, "").replace(VOID, "")
    return w.strip(_AROUND)


def letter_before(m: str, a: int, i: int) -> str:
    """The last letter before i, '' for none."""
    i -= 1
    while i >= a and not m[i].isalpha():
        i -= 1
    return m[i] if i >= a else ""


def language(lang: str | None) -> str:
    """A declared language without case and additions; '' for none."""
    code = (lang or "").strip().lower().split("-")[0]
    return {"simple": "en", "und": ""}.get(code, code)


# --- first pass -------------------------------------------------------------------------------------------------

_WORDS = re.compile(f"[{_LETTERS}]+")
PAGES = 3  #: pages a word must be seen on, so that the many copies of a page's text count once


_PERIOD = re.compile(r"(?<!\.)\.(?=[\s\x01\x02\x03\"”»)]|$)")


def count_part(part: str, times: int, pages_of: set[int], words: Counter, counts: Counter, pages: dict[str, set[int]]) -> None:
    """Adds a paragraph's words, and its events: 'p' periods behind a word, 'e' those at a paragraph's end, 'l' before a small letter or sign,
    'u' before a capital, 's' words at a paragraph's start, 'v' capitals behind a period, 'c' both words around a period, 'n' paragraphs; and for words with a
    period or at a start some of their pages."""
    if _THAI.search(part):
        pieces = [p for p in part.split() if p]
        if pieces:
            counts["ts", _head(pieces[0], 3)] += times
            for p in pieces[1:]:
                counts["tm", _head(p, 3)] += times
        return
    counts["n", ""] += times
    if _CJK.search(part):
        counts["ts", _head(part, 2)] += times
        for x in _DOTS.finditer(part):
            head = _head(part, 2, x.end())
            if _CJK.match(head):
                counts["tm", head] += times
    found = _WORDS.findall(part)
    if found:
        counts["s", found[0]] += times
        _seen(pages, found[0], pages_of)
        if times == 1:
            words.update(found)
        else:
            for w in found:
                words[w] += times
    for x in _PERIOD.finditer(part):
        i = x.start()
        w = word_before(part, 0, i)
        if not w:
            continue
        w = word_type(w)
        counts["p", w] += times
        _seen(pages, w, pages_of)
        word = _NEXT.match(part, i + 1).group("word")
        first = word[:1]
        if first.isalnum():
            if first.isupper():
                counts["u", w] += times
                counts["v", word] += times
                if len(w) <= 5 or "." in w:
                    both = f"{w}\t{word}"
                    counts["c", both] += times
                    _seen(pages, both, pages_of)
            else:
                counts["l" if first.isdigit() or _CASED.match(first) else "o", w] += times
        elif not first or not part[i + 1 :].strip(" \n\t\x01\x02\x03\"”»)"):
            counts["e", w] += times
        else:
            counts["l" if first in ",;:" else "o", w] += times


def _seen(pages: dict[str, set[int]], w: str, some: set[int]) -> None:
    known = pages.setdefault(w, set())
    if len(known) < PAGES:
        known.update(some)


_DOTS = re.compile("…+|\\.{3,}")


def _head(p: str, n: int, at: int = 0) -> str:
    """The first n letters from ``at`` on, without markup and opening signs."""
    out = ""
    while at < len(p) and len(out) < n:
        ch = p[at]
        if ch not in "\x01\x02\x03" and (out or ch not in "'\"“(「『《"):
            out += ch
        at += 1
    return out


def ratio(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's log-likelihood ratio of k1 in n1 against k2 in n2; negative where the first rate is lower, 0 without counts."""

    def ll(k: Column, n: Column, p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(p) + (n - k) * F.log(1 - p)

    one, two = F.greatest(n1, F.lit(1)), F.greatest(n2, F.lit(1))
    p1, p2, p = k1 / one, k2 / two, (k1 + k2) / (one + two)
    out = 2 * (ll(k1, n1, p1) + ll(k2, n2, p2) - ll(k1, n1, p) - ll(k2, n2, p))
    return F.when((n1 == 0) | (n2 == 0), 0.0).when(p1 >= p2, out).otherwise(-out)


def learn(documents: DataFrame, scratch: Scratch) -> dict[str, Model]:
    """A model of each language from counts over all documents.

    Tasks count in themselves and hand over sums, so what is shuffled are words, not texts.  Words are classified in
    their table; only those with a verdict reach the driver, for each language and kind 1 / SHARE at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple[str, str], list] = {}
        held = 0
        for batch in batches:
            for lang, text, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if text:
                    m = mask(text)
                    lang = language(lang)
                    for a, b in units(text, m):
                        part = m[a:b]
                        known = parts.get((lang, part))
                        if known is None:
                            parts[lang, part] = [1, {page}]
                            held += len(part)
                        else:
                            known[0] += 1
                            if len(known[1]) < PAGES:
                                known[1].add(page)
            if held > CACHE:
                yield _counted(parts)
                parts, held = {}, 0
        yield _counted(parts)

    counted = documents.select("lang", "text", F.coalesce("page_id", "doc_id", F.lit(0)).alias("page")).mapInArrow(count, "lang string, kind string, word string, n long, pages array<long>")
    kinds = ["w", "p", "e", "l", "u", "o", "s", "v", "c", "n", "ts", "tm"]
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in kinds]
    # Each task names three pages of a word at most, so these sets stay small.
    several = F.size(F.array_distinct(F.flatten(F.collect_set("pages")))).alias("pages")
    table = scratch.cut(counted.groupBy("lang", "word").agg(*sums, several))
    totals = scratch.cut(table.groupBy("lang").agg(*[F.sum(c).alias(f"all_{c}") for c in kinds]))
    whole = totals.agg(F.coalesce(F.sum("all_e"), F.lit(0)).alias("e"), F.coalesce(F.sum("all_p"), F.lit(0)).alias("p")).first()
    c = F.col
    least = lambda n, of: F.greatest(F.lit(n), F.ceil(c(f"all_{of}") * SHARE))
    small = table.where("w > 0").select("lang", c("word").alias("lower"), c("w").alias("w_small"))
    rows = table.where("p > 0 OR s > 0 OR tm > 0 OR v > 0").withColumn("lower", F.lower("word")).join(small, ["lang", "lower"], "left").join(totals, "lang")
    number = c("word").startswith("#")
    dotted = (c("p") >= least(LEAST, "p")) & (c("p") * 10 >= c("w") * 7)
    # A word mostly written with its period, more often than words are, and seen going on behind it, or less often
    # at a paragraph's end than other periods.
    bound = ratio(c("p"), F.greatest("w", "p"), c("all_p"), c("all_w")) >= STARTS
    rare_end = ratio(c("e"), c("p"), F.lit(whole.e), F.lit(whole.p)) <= -3.84
    cases = c("pages") >= PAGES
    is_start = c("s") >= least(3, "s")
    verdicts = {
        "abbreviations": cases & dotted & ~number & bound & ((c("l") * 4 >= c("p")) | rare_end),
        "ending": cases & (number | dotted | is_start) & (c("e") > 0) & (c("e") * 10 >= c("e") + c("u")),
        "starters": cases & is_start & (ratio(c("s"), F.greatest("w", "s"), c("all_s"), c("all_w")) >= STARTS) & (c("s") * 20 >= c("w")),
        "small": cases & is_start & F.substring("word", 1, 1).rlike("\\p{Ll}"),
        "common": cases & ((c("v") >= least(3, "v")) | is_start) & (c("w_small") >= 3) & (c("w_small") * 3 >= c("w")) & F.substring("word", 1, 1).rlike("\\p{Lu}"),
        "follows": (c("tm") >= least(5, "tm")) & (c("ts") == 0) & (ratio(c("ts"), c("tm"), c("all_ts"), c("all_ts") + c("all_tm")) <= -STARTS),
    }
    flags = sum((F.when(F.coalesce(v, F.lit(False)), 1 << KINDS.index(k)).otherwise(0) for k, v in verdicts.items()), F.lit(0))
    # The contrary of a kind, plainly seen: hardly ever with a period, hardly ever first, hardly ever small.
    seen = c("w") >= OFTEN
    often = {"abbreviations": seen & (c("p") * 10 < c("w")), "starters": seen & (c("s") * 100 < c("w")), "small": seen & (c("s") * 200 < c("w")), "common": seen & (F.coalesce("w_small", F.lit(0)) * 20 < c("w"))}
    sure = sum((F.when(v, 1 << KINDS.index(k)).otherwise(0) for k, v in often.items()), F.lit(0))
    judged = scratch.cut(rows.select("lang", "word", flags.alias("flags"), sure.alias("sure")).where("flags > 0 OR sure > 0"))
    any_ = judged.where("flags > 0").groupBy("word").agg(F.bit_or("flags").alias("any"))
    judged = judged.join(any_, "word").select("lang", "word", "flags", F.expr("any & sure & ~flags").alias("denied")).where("flags > 0 OR denied > 0")
    # Collocations: of all words, those that follow this word's period.
    around = table.where("c > 0").select("lang", F.split_part("word", F.lit("\t"), F.lit(1)).alias("first"), F.split_part("word", F.lit("\t"), F.lit(2)).alias("second"), "word", c("c").alias("k"), "pages")
    around = around.join(totals, "lang").where((c("k") >= least(LEAST, "c")) & cases)
    around = around.join(table.select("lang", c("word").alias("first"), c("p").alias("p_first")), ["lang", "first"]).join(table.select("lang", c("word").alias("second"), c("w").alias("w_second")), ["lang", "second"])
    tied = ratio(c("k"), c("p_first"), F.greatest(c("w_second") - c("k"), F.lit(0)), F.greatest(c("all_w") - c("p_first"), F.lit(1))) >= TOGETHER
    around = around.where(tied).select("lang", "word", F.lit(1 << KINDS.index("together")).alias("flags"), F.lit(0).alias("denied"))
    learned = scratch.cut(judged.unionByName(around))
    scratch.drop(table)
    models: dict[str, Model] = {r["lang"]: Model() for r in totals.select("lang").toLocalIterator()}
    for r in learned.toLocalIterator():
        for i, kind in enumerate(KINDS):
            if r["flags"] >> i & 1:
                getattr(models[r["lang"]], kind).add(r["word"])
            if r["denied"] >> i & 1:
                models[r["lang"]].denied.setdefault(kind, set()).add(r["word"])
    scratch.drop(totals, learned)
    return models


def _counted(parts: dict[tuple[str, str], list]) -> pa.RecordBatch:
    by: dict[str, tuple[Counter, Counter, dict[str, set[int]]]] = {}
    for (lang, part), (times, some) in parts.items():
        count_part(part, times, some, *by.setdefault(lang, (Counter(), Counter(), {})))
    rows = [(lang, "w", w, n, None) for lang, (words, _, _) in by.items() for w, n in words.items()]
    rows += [(lang, k[0], k[1], n, None) for lang, (_, c, _) in by.items() for k, n in c.items()]
    rows += [(lang, "", w, 0, sorted(some)[:PAGES]) for lang, (_, _, pages) in by.items() for w, some in pages.items()]
    cols = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "kind", "word", "n", "pages"])


# --- second pass ------------------------------------------------------------------------------------------------


@dataclass
class Judge:
    """Decides for the documents of a language: by its own statistics of a word, or, where it is rare in them, by those of all languages."""

    own: Model
    abbreviations: set[str]
    starters: set[str]
    common: set[str]
    small: set[str] = field(default_factory=set)
    ending: set[str] = field(default_factory=set)
    follows: set[str] = field(default_factory=set)
    together: set[str] = field(default_factory=set)
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)
    held: int = 0

    @staticmethod
    def of(own: Model, models: list[Model]) -> Judge:
        def every(name: str) -> set[str]:
            return set().union(*[getattr(x, name) for x in models]) - own.denied.get(name, set()) | getattr(own, name)

        numbers = {w for w in own.ending if w.startswith("#")}
        ending = {w for w in every("ending") if not w.startswith("#")} | numbers
        return Judge(own, every("abbreviations"), every("starters"), every("common"), every("small"), ending, every("follows"), every("together"))

    def ends(self, text: str, m: str) -> list[int]:
        out: list[int] = []
        for a, b in units(text, m):
            part = m[a:b]
            found = self.seen.get(part)
            if found is None:
                here: list[int] = []
                (self.thai if _THAI.search(part) else self.unit)(part, 0, len(part), here)
                found = tuple(here)
                if self.held > CACHE:
                    self.seen.clear()
                    self.held = 0
                self.seen[part] = found
                self.held += len(part)
            out += [a + e for e in found]
        return out

    def starts(self, word: str) -> bool:
        """Whether a word starts sentences; one that takes a period itself, only in this language."""
        if len(word) == 1 or word in self.abbreviations:
            return word in self.own.starters and word not in self.own.abbreviations
        return word in self.starters or word in self.common

    def unit(self, m: str, a: int, b: int, out: list[int]) -> None:
        spans = enclosed(m, a, b)
        at = 0
        begun = a
        done = a
        for x in _STOP.finditer(m, a, b):
            i, j = x.span()
            if i < done:
                continue
            while at < len(spans) and spans[at][1] <= i:
                at += 1
            mark = x.group()
            if mark == ";" and not _GREEK.match(letter_before(m, a, i)):
                continue
            inside = at < len(spans) and spans[at][0] < i
            quoted = False
            k = j
            if inside:
                close = spans[at][1]
                if m[j : close - 1].strip(" \xa0 " + MARK + VOID + CLOSERS):
                    continue
                quoted = spans[at][2]
                if not quoted and spans[at][0] > begun:
                    continue
                k = close
            while k < b and (m[k] in CLOSERS and not self.opens(m, k, b) or m[k] in NOTE + MARK):
                k += 1
            if k > j and not inside and _CLOSED.search(m, j, k):
                quoted = True
            # Markup that opens the next words is not the sentence's.
            while k > j and m[k - 1] == MARK and k < b and not m[k].isspace():
                k -= 1
            if k >= b:
                break
            if self.ends_here(m, a, b, i, j, k, mark, quoted):
                out.append(k)
                done = k
                begun = k
                while begun < b and (m[begun].isspace() or m[begun] in VOID):
                    begun += 1
        if not out or out[-1] != b:
            out.append(b)

    @staticmethod
    def opens(m: str, k: int, b: int) -> bool:
        """A straight quotation mark, or one that also opens, with text directly behind it opens a quotation."""
        return m[k] in "\"'»" and k + 1 < b and m[k + 1].isalnum()

    def ends_here(self, m: str, a: int, b: int, i: int, j: int, k: int, mark: str, quoted: bool) -> bool:
        last = mark[-1]
        opened, word = _NEXT.match(m, k, b).groups()
        if opened:
            opened = opened.strip(MARK + VOID)
        spaced = m[k].isspace()
        if not word and not opened:
            return True
        if not (word[:1].isalnum() or _SPOKEN.search(m, k, b)):
            return False  # only signs are left: they go with the sentence
        if last == "．" and m[i - 1 : i].isdigit() and m[j : j + 1].isdigit():
            return False
        if word[:1] in "とっ" and not opened and _REPORTED.match(word):
            return False
        dash = word[:1] in "—–-" and not opened
        if last in SURE and last not in "!?":
            # A mark of a script without spaces or with its own full stop.
            if quoted:
                return self.behind_quote(m, a, k, b, word, opened)
            return word[:1] not in "，、,;；" and not dash
        if mark == ";":
            return spaced
        if last in "!?":
            if not spaced and not quoted and not _CJK.match(word) and not word[:1].isupper():
                return False
            if dash or word[:1] in ",;:":
                return False
            if quoted:
                return self.behind_quote(m, a, k, b, word, opened)
            return True
        if not spaced and k == j and not (_CJK.match(word) and mark != "."):
            # A missing space: a word, not an abbreviation, and a word that starts sentences or follows one written small.
            if mark != "." or not word[:1].isupper() or not word[1:2].islower():
                return False
            raw = word_before(m, a, i)
            if len(raw) < 3 or not raw.isalpha():
                return False
            return (raw.islower() or self.starts(word)) and (raw not in self.abbreviations or self.starts(word))
        if mark == ".":
            return self.period(m, a, i, word, opened, quoted, k, b)
        # Dots: the sentence goes on with a small letter, unless that word starts sentences.
        if dash or word[:1] in ",;:":
            return False
        if quoted:
            return self.behind_quote(m, a, k, b, word, opened)
        if word[:1].islower():
            return word in self.small
        if _CJK.match(word) and _head(m, 2, k) in self.follows:
            return False
        return not word[:1].isdigit() or bool(opened)

    def behind_quote(self, m: str, a: int, k: int, b: int, word: str, opened: str) -> bool:
        """Whether what follows a quotation with its own full stop is a sentence of its own and not its report."""
        if word[:1] in ",;:，、；：" or word[:1] in "—–-" and not opened:
            return False
        if _CASED.match(word):
            return word[:1].isupper() or word in self.small
        if word[:1].isdigit():
            return True
        stop = _STOP.search(m, k, b)
        clause = m[k : stop.start() if stop else b]
        clause = clause.replace(MARK, "").replace(VOID, "").lstrip()
        if opened and _CJK.match(letter_before(m, a, k)):
            # A second quotation right behind the first: both are reported together, or neither.
            end = m.find(CLOSE.get(opened[0], "”")[0], k, b)
            if end >= 0:
                stop = _STOP.search(m, end, b)
                clause = m[end + 1 : stop.start() if stop else b].replace(MARK, "").replace(VOID, "").lstrip()
        if LEADING_ON.match(clause):
            return False
        if word in self.starters:
            return True
        # A quotation that was led up to, by a colon or comma, ends with its sentence.
        at = max(m.rfind(sign, a, k) for sign in "“«「\"„") - 1
        if at >= a and m[at].isspace():
            at -= 1
        if at >= a and m[at] in ":：，,、":
            return True
        return not SAYING.search(clause)

    def period(self, m: str, a: int, i: int, word: str, opened: str, quoted: bool, k: int, b: int) -> bool:
        if word[:1] in ",;:" or word[:1] in "—–-" and not opened:
            return False
        if quoted:
            return self.behind_quote(m, a, k, b, word, opened)
        raw = word_before(m, a, i)
        w = word_type(raw)
        if word[:1].islower() and _CASED.match(word):
            return word in self.small and not (w in self.abbreviations or len(raw) == 1) and not opened
        if word[:1].isdigit() and not opened:
            return word in self.own.starters and w not in self.abbreviations and len(raw) > 1
        if not raw:
            return True
        short = len(raw) == 1 and raw.isalpha() or "." in raw
        if short and len(word) == 1 and word.isalpha():
            at = m.find(word, k, b)
            if m[at + 1 : at + 2] == ".":
                return False
        if w not in self.ending and (short or w.startswith("#") or w in self.abbreviations) and f"{w}\t{word}" in self.together and word not in self.starters:
            return False
        if w in self.abbreviations or short or w.startswith("#") and w not in self.ending:
            if w.startswith("#"):
                return self.starts(word) or bool(opened)
            if _CASED.match(word):
                return self.starts(word) or w in self.ending
            return word in self.own.starters
        return True

    def thai(self, m: str, a: int, b: int, out: list[int]) -> None:
        """Spaces end sentences unless a phrase behind them never starts a paragraph, or a number, sign or quotation goes on."""
        spans = enclosed(m, a, b)
        start = a
        for x in _SPACES.finditer(m, a, b):
            i, j = x.span()
            last = m[start:i].rstrip(MARK + VOID + NOTE)  # the run of letters before the space
            stop = start + len(last)
            start = j
            ahead = _RUN.match(m, j, b)
            rest = ahead.group(1) if ahead else ""
            head = _head(rest, 3)
            within = any(s < i < e for s, e, _ in spans)
            after = rest.lstrip(MARK + VOID)[:1]
            if not _THAI.search(last) or not (_THAI.search(rest) or after in "\"“«'(" or after.isdigit()):
                # Text of another script, or the border to it: its marks count, and a capital behind Thai.
                e = i
                while e > a and m[e - 1] in CLOSERS + NOTE + MARK + VOID:
                    e -= 1
                f = e
                while f > a and m[f - 1] in STOPS:
                    f -= 1
                if f < e:
                    if not within and (_THAI.match(after) and m[e - 1] in SURE or self.ends_here(m, a, b, f, e, i, m[f:e], any(ch in "\"'”’»" for ch in m[e:i]))):
                        out.append(i)
                    continue
                if not (_THAI.search(last) and after.isupper()) and not _THAI.search(rest):
                    continue
            if within or not head or after.isdigit() or after in "\"“«'({" or head in self.follows or last.endswith("ๆ"):
                continue
            if last[-1:] in "!?…" or not after.isascii() or after.isupper():
                out.append(i)
            elif last[-1:] == ".":
                raw = word_before(m, a, stop - 1)
                if not (raw in self.abbreviations or len(raw) == 1):
                    out.append(i)
        if not out or out[-1] != b:
            out.append(b)


_SPACES = re.compile(r"\s+")
_RUN = re.compile(r"[\x02\x03\s]*(\S+)")


def sentences(documents: DataFrame) -> DataFrame:
    """``doc_id, sent_end``: the end of each sentence, counted in code points from the text's beginning.

    documents: ``doc_id, lang, text`` and, if there, ``page_id``.  Null, empty and blank texts, and texts of markup only, have no sentence; a null
    or unknown language uses what all languages share.  Repeated rows give repeated sentences.  Whole texts are read.
    """
    scratch = Scratch(documents.sparkSession, "sentences")
    page = F.col("page_id").cast("long") if "page_id" in documents.columns else F.lit(None).cast("long")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), page.alias("page_id"))
    models = learn(rows, scratch)
    every = list(models.values())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges: dict[str, Judge] = {}
        for batch in batches:
            ids, ends = [], []
            for doc, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not text:
                    continue
                key = language(lang)
                judge = judges.get(key)
                if judge is None:
                    judge = judges[key] = Judge.of(models.get(key, Model()), every)
                found = judge.ends(text, mask(text))
                ids += [doc] * len(found)
                ends += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ends, pa.int64())], ["doc_id", "sent_end"])

    return rows.select("doc_id", "lang", "text").mapInArrow(split, "doc_id long, sent_end long")
