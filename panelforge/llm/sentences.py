"""Problem 10: sentence units of documents in any language and script.

The rules are those of the standard sentence-break properties: units end at the terminators of all scripts (STerm, ATerm)
with the closing marks behind them (Close), unless what follows or an abbreviation forbids it. On top come abbreviations and
ordinals by language, quotations and brackets that hold whole sentences, lists, blank lines, and the space as a terminator
in Thai, Lao, Khmer and Burmese. Language tags are not trusted: the languages of a text are told by its common words, and
their abbreviations apply; a text without such words has those of all languages. Words that are abbreviations only sometimes
(no, max, art, Jan.) are told by what follows.

Defined results. Null, empty and blank texts have no units. Repeated texts each get their own. Positions count code points.
A quotation or bracket without its partner in the same paragraph is an ordinary character. Texts of any length are read
once from left to right.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
import regex as re
from pyspark.sql import DataFrame

from panelforge.session import spread

# Abbreviations by language. Titles and plain ones never end a sentence; numbered ones don't before a number,
# a numeral or a letter, months and measures not before a digit, scales only before a word that begins sentences, and
# `closing` ones may end one. Scripts of their own are
# under "any" like all that is no ordinary word elsewhere, as no other language's words can be taken for them.
ABBREVIATIONS = {
    "any": {
        "titles": "dr mr mrs prof ing st mme mlle sra srta д-р проф акад डॉ श्री प्रो د",
        "plain": "z ca approx aprox bzw vgl vs tel ext resp e.g i.e см напр ок ср им ул тыс ред т.е",
        "numbered": "nr núm pág págs fig figs tab tabs p pp abb n с стр рис табл гл п пп ст ص पृ สพ",
        "months": "", "measures": "тыс", "scales": "", "closing": "etc usw al inc ltd co corp u.p u.s u.k u.n a.m p.m чел г гг т.д т.п др д п.м",
    },
    "en": {
        "titles": "ms rev gen col capt lt jr", "plain": "cf viz incl excl const stat dept env ed eds", "numbered": "no nos sec secs ch chap art vol p pp num",
        "months": "jan feb mar apr jun jul aug sep sept oct nov dec", "measures": "max min", "scales": "", "closing": "am pm h min hrs yrs ff seq bros ave",
    },
    "de": {
        "titles": "hr fr frl mag dipl", "plain": "z.b d.h u.a incl excl inkl exkl", "numbered": "kap bd abs abt art",
        "months": "jan feb mär apr jun jul aug sep sept okt nov dez", "measures": "max min", "scales": "mio mrd tsd", "closing": "hab einw u h ff",
    },
    "fr": {
        "titles": "mm mgr", "plain": "env p.ex ex cf excl incl", "numbered": "no nos chap art vol pag",
        "months": "janv févr mars avr mai juin juil août sept oct nov déc", "measures": "max min", "scales": "mio mrd", "closing": "hab h",
    },
    "es": {
        "titles": "sr dra sres", "plain": "p.ej ej excl incl", "numbered": "no num art cap vol",
        "months": "ene feb mar abr may jun jul ago sep sept oct nov dic", "measures": "max min máx mín", "scales": "", "closing": "hab h ee.uu",
    },
}
#: Words by which the language of a text in Latin letters is told.
COMMON = {
    "en": "the of and to is was were in that for with by from at this",
    "de": "der die das und ist wurde wurden nicht mit von im den dem ein eine",
    "fr": "le les et des une est dans du pour par sur au aux la ne",
    "es": "el los las y que del una por con para se su no la como",
}
MONTHS = """
januar februar märz april mai juni juli august september oktober november dezember jänner halbjahr quartal jahrhundert jahr monat
woche tag platz mal lieferung auflage ausgabe band kapitel
""".split()
ORDINAL_BEFORE = "am im zum vom der den dem des die das beim seit ab bis ein eine einen einem einer jeder jeden".split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday est edt gmt utc cet".split()
#: Nouns after which a single letter is a label rather than an initial.
LABELLED = "batch annex table sheet option plan column appendix group part section type class grade team unit item zone phase version stapel anhang gruppe tabelle lote anexo grupo tabla annexe groupe tableau lot партия группа таблица".split()
#: Words that begin sentences and aren't names.
STARTERS = """
the a an in on at of for from before after since as is was are our one we it this that these there every contrary see no blank stop
then he she they you i but and so if when while where who what why how his her their its my not all some many most each both
by with to until during although because however yet still now here thus meanwhile later soon once
der die das ein eine er sie es wir ihr dann danach aber und wenn weil als im am nach seit bis
le la les un une il elle ils elles nous vous on puis mais et si quand dans depuis après
el los las una ella ellos luego pero y cuando desde después
""".split()
SAYING = re.compile(r"\A\s*(?:[\p{L}.'’-]+\s+){1,4}(?:asked|said|wrote|replied|answered|added|noted)\b")
CJK_SAYING = re.compile(r"\A[^。！？!?]{0,60}?(?:问|問|说|說|道|写|寫|答|云|称|言った|書いた|尋ねた|述べた|答えた|話した|という)[^。！？!?]{0,12}[。！？!?]")

BLANK_LINE = re.compile(r"(?>\r\n|[\n\r\v\f\x85 ])[^\S\n\r\v\f\x85  ]*+(?:(?>\r\n|[\n\r\v\f\x85 ])[^\S\n\r\v\f\x85  ]*+)+| ")
LINE = re.compile(r"[^\n\r]*(?:\r\n|\n|\r|\Z)")
MARKER = re.compile(r"[^\S\n]*(?:[-*+•‣◦▪●·]|\(?\d{1,3}[.)]|\(?[a-z][)])[^\S\n]+\S")
OPEN = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "「": "」", "『": "』", "《": "》", "〈": "〉", "«": "»", "“": "”", "„": "“", "‹": "›", "〔": "〕"}
CLOSE = set(OPEN.values())
BRACKETS = set("([{（［【〔")
#: Everything at which the state changes: runs of terminators, quotation marks and brackets, and spaces between letters of
#: scripts that end sentences by a space.
SPACED = r"\p{Script=Thai}\p{Script=Lao}\p{Script=Khmer}\p{Script=Myanmar}"
EVENT = re.compile(rf"(?P<term>(?!\.[\p{{N}}\p{{Ll}}])[\p{{Sentence_Break=STerm}}\p{{Sentence_Break=ATerm}}…]+)|(?P<mark>[\"()\[\]{{}}（）［］【】〔〕「」『』《》〈〉«»“”„‹›])|(?P<space>(?<=[{SPACED}])\s+(?=[{SPACED}]))")
GLUED = re.compile(r"(?:(?<![/:@][\w.-]*)\p{Ll}{2,}|(?<![\p{L}_/:@])[\p{N}.,]*\p{N}|[)»”])[.!?]+(?:\p{Lu}[\p{Ll}\s'’.-]|[¿¡«„“])\Z")
INVISIBLE = re.compile(r"\p{Cf}+")
BLANKS = re.compile(r"[\s\p{Cf}]*+")
INNER_POINTS = re.compile(r"(?:\p{L}\.)+\p{L}")
NUMERAL = re.compile(r"\W*+(?:\p{L}*\p{N}|[IVXLC]+\b|\p{Lu}\b)")
TAIL = re.compile(r"[\p{Sentence_Break=STerm}\p{Sentence_Break=ATerm}]+[\p{Sentence_Break=Close}\"'’]*\Z")
WORD_BEFORE = re.compile(r"[\p{L}\p{M}\p{N}.\p{Cf}-]{1,40}\Z")
PREVIOUS = re.compile(r"([\p{L}\p{M}\p{Cf}]+)(\.?)\s*\Z")
NEXT_WORD = re.compile(r"[\p{L}\p{M}\p{Cf}]+")
IDEOGRAPHIC = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}　-〿＀-￯]")
MONTH_SET, ORDINAL_SET, WEEKDAY_SET, LABEL_SET, STARTER_SET = map(frozenset, (MONTHS, ORDINAL_BEFORE, WEEKDAYS, LABELLED, STARTERS))
COMMON_SETS = {lang: frozenset(words.split()) for lang, words in COMMON.items()}
#: A text with fewer distinct common words doesn't tell its language.
TOLD = 5
#: No abbreviation has so many letters.
LONG_WORD = 7


class Book:
    """The abbreviations of a set of languages."""

    def __init__(self, langs: tuple[str, ...]) -> None:
        take = lambda kind: frozenset(w for lang in ("any", *langs) for w in ABBREVIATIONS[lang][kind].split())
        self.titles, self.plain, self.numbered, self.months, self.measures, self.scales, self.closing = map(take, ("titles", "plain", "numbered", "months", "measures", "scales", "closing"))
        self.never = self.titles | self.plain
        self.all = self.never | self.numbered | self.months | self.measures | self.scales | self.closing


@functools.cache
def _book(langs: tuple[str, ...]) -> Book:
    return Book(langs)


def book_of(text: str) -> Book:
    """The abbreviations of the languages that a text is written in, told by its common words; of all where it has none."""
    words = set(text.lower().split())
    seen = {lang: len(words & common) for lang, common in COMMON_SETS.items()}
    top = max(seen.values())
    return _book(tuple(lang for lang, n in seen.items() if 3 * n >= top or top < TOLD))


def _pairs(text: str, marks: list[re.Match]) -> dict[int, int]:
    """Places of opening marks and of their partners."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []

    def shut(want: str, at: int) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == want:
                out[stack[k][1]] = at
                del stack[k:]
                return True
        return False

    for m in marks:
        c, at = m.group(), m.start()
        if c == '"':
            if not shut('"', at) and at + 1 < len(text) and not text[at + 1].isspace():
                stack.append(('"', at))
        elif c == "“":
            if not shut("“", at):
                stack.append(("”", at))
        elif c in CLOSE and shut(c, at):
            continue
        elif c in OPEN:
            stack.append((OPEN[c], at))
    return out


def _behind(text: str, at: int, shutting: set[int]) -> int:
    """The place behind the closing marks at `at`; a straight or turned mark closes only if it is some opener's partner."""
    while at < len(text):
        k = at
        while k < len(text) and text[k] in " \u00a0\u202f\u2009" and k - at < 2:
            k += 1
        if k > at and not (k < len(text) and text[k] in "»›" and k in shutting):
            break
        if k < len(text) and (k in shutting or (text[k] in CLOSE and text[k] != "“") or text[k] in "'’"):
            at = k + 1
        else:
            break
    return at


def _first_visible(text: str, at: int) -> str:
    at = BLANKS.match(text, at).end()
    return text[at] if at < len(text) else ""


def _word_before(text: str, at: int) -> str:
    """The letters, digits, points and hyphens that end at `at`, at most forty."""
    rest = text[max(0, at - 40) : at]
    if not rest or rest[-1].isspace():
        return ""
    rest = rest.split()[-1]
    if rest.isalpha():
        return rest
    m = WORD_BEFORE.search(rest)
    return m.group() if m else ""


def _is_long(text: str, at: int) -> bool:
    """Whether the word before `at` is longer than any abbreviation."""
    last = text[max(0, at - LONG_WORD) : at]
    return len(last) == LONG_WORD and last.isalpha() and last.islower()


def _abbreviation(text: str, at: int, after: int, book: Book) -> bool:
    """Whether the full stop at `at` belongs to an abbreviation or number that the sentence goes on after; `after`: behind its closers."""
    if _is_long(text, at):
        return False
    raw = _word_before(text, at)
    if not raw:
        return False
    seen = raw if raw.isalpha() else INVISIBLE.sub("", raw)
    if len(seen) > 1 and IDEOGRAPHIC.match(seen[-2]):
        seen = seen[-1]  # a name after a script without spaces
    if "." in seen and any(len(p) > 2 for p in seen.split(".")):
        seen = seen.rsplit(".", 1)[-1]  # a word glued to the sentence before
    word = seen.lstrip(".-").lower()
    bare = word if word in book.all else word.rsplit("-", 1)[-1]
    if len(bare) > 1 and bare not in book.all and "." not in bare and not word.isdigit():
        return False
    if bare in book.never:
        # A single capital is an initial or a label, whatever abbreviation it may be in lower case.
        if len(bare) > 1 or not seen[-1].isupper():
            return True
    nxt = _first_visible(text, after)
    goes_on = nxt.isdigit() or nxt.islower() and not _camel(text, after)
    if len(bare) > 1 and not word.isdigit():
        if bare in ("др",) and _prior(text, at, raw)[0] in ("т", "и"):
            return nxt.islower() and not _camel(text, after)
        known = bare in book.all
        if not known and not INNER_POINTS.fullmatch(bare):
            return False
        if goes_on or known and nxt in ",;:)-–—%":
            return True
        if bare in book.numbered:
            return bool(NUMERAL.match(text, after))
        if bare in book.scales:
            return _follow(text, after) not in STARTER_SET
        if bare in book.closing:
            return _follow(text, after) in WEEKDAY_SET
        follow = _follow(text, after)
        return bool(follow) and follow not in STARTER_SET
    prior, stopped = _prior(text, at, raw)
    if word.isdigit():
        follow = _follow(text, after)
        return len(word) <= 2 and (follow in MONTH_SET and nxt.isupper() or prior in ORDINAL_SET and bool(follow))
    if bare == "b" and prior == "z" or bare == "h" and prior == "d" or bare == "a" and prior == "u" or bare == "e" and prior == "т":
        return True
    if bare == "г" or bare in ("д", "п") and prior in ("т", "и"):
        return nxt.islower() and not _camel(text, after)
    if seen[-1].isupper():
        # A letter before a word that begins sentences is a label, else an initial.
        return not (prior in LABEL_SET and not stopped or _follow(text, after) in STARTER_SET)
    return goes_on or bare in book.numbered and bool(NUMERAL.match(text, after))


def _follow(text: str, after: int) -> str:
    """The word behind `after`, blanks and opening marks aside, in lower case; none for an initial."""
    m = NEXT_WORD.search(text, after, min(len(text), after + 40))
    if not m or text[after : m.start()].strip("\"'«“„(¿¡[ \n\r\t ") != "":
        return ""
    word = INVISIBLE.sub("", m.group()).lower()
    return "" if len(word) == 1 and m.end() < len(text) and text[m.end()] == "." else word


def _prior(text: str, at: int, raw: str) -> tuple[str, bool]:
    """The word before the one that ends at `at`, in lower case, and whether a full stop is behind it."""
    start = at - len(raw)
    m = PREVIOUS.search(text, max(0, start - 40), start)
    return (INVISIBLE.sub("", m.group(1)).lower(), bool(m.group(2))) if m else ("", False)


def _camel(text: str, at: int) -> bool:
    """Whether the word at `at` is written like a brand, lower case first, then upper case."""
    m = NEXT_WORD.search(text, at, min(len(text), at + 40))
    return bool(m and len(m.group()) > 1 and m.group()[0].islower() and any(c.isupper() for c in m.group()[1:3]))


def _ends(text: str, run: str, at: int, after: int, book: Book) -> bool:
    """Whether a run of terminators at `at` outside all marks ends a sentence; `after` is behind the closing marks."""
    if after >= len(text):
        return True
    if run == "." and text[after] == " " and text[after + 1 : after + 2].isupper() and _is_long(text, at):
        return True  # the usual case, settled without looking further
    if run[-1] in "。！？｡．।॥۔" or run[-1] == "؟":
        return True
    if not text[after].isspace():
        # A space was lost where prose or a number ends and a capital or an opening mark follows at once.
        if after == at + len(run) and (text[after].isupper() or text[after] in "¿¡«„“") and GLUED.search(text, max(0, at - 40), min(len(text), after + 2)):
            return run[-1] in "!?" or not _abbreviation(text, at, after, book)
        # Scripts without spaces end sentences with a western mark, too.
        return run[-1] in "!?" and bool(IDEOGRAPHIC.match(text[after])) and bool(IDEOGRAPHIC.match(text[at - 1] if at else "x"))
    nxt = _first_visible(text, after)
    if not nxt:
        return True
    lower = nxt.islower() and not _camel(text, after)
    if run.strip("…") == "" or (len(run) > 1 and run.strip(".") == ""):
        return not lower and nxt not in ",;:)"
    if set(run) <= {"."} or run[-1] in ".․﹒":
        if "!" in run or "?" in run:
            return True
        if _abbreviation(text, at, after, book):
            return False
        if lower:
            # Standard rules go on before lower case; only a full word of prose or a number settles that it ended.
            word = _word_before(text, at)
            return bool(word) and (len(INVISIBLE.sub("", word)) >= 4 or word[-1].isdigit())
        return nxt not in ",;:"
    return nxt not in ",;:"


def _after_group(text: str, start: int, opened: int, end: int, inner: str) -> bool:
    """Whether a sentence ends behind a quotation or bracket that closes a sentence inside; `end` is behind its closers."""
    if end >= len(text):
        return True
    own = any(c.isalnum() for c in text[start:opened])
    nxt = _first_visible(text, end)
    if not nxt:
        return True
    if nxt.islower() and not _camel(text, end) or nxt in ",;:，、；：—–-.。！？!?)）…%":
        return False
    wide = bool(IDEOGRAPHIC.match(text[opened])) or bool(IDEOGRAPHIC.match(inner))
    if text[opened] in BRACKETS:
        return True if wide or text[end].isspace() else False
    if wide or bool(IDEOGRAPHIC.match(nxt)):
        if "぀" <= nxt <= "ゟ":
            return False
        return own or not CJK_SAYING.match(text[end : end + 90])
    if not text[end].isspace():
        return False
    return own or not SAYING.match(text[end : end + 120])


def _block_units(text: str, lo: int, hi: int, book: Book) -> Iterator[int]:
    """Ends of the units of one paragraph of prose, text[lo:hi]."""
    part = text[lo:hi]
    events = list(EVENT.finditer(part))
    pairs = _pairs(part, [m for m in events if m.lastgroup == "mark"])
    shutting = set(pairs.values())
    start, skip = 0, 0
    for m in events:
        at = m.start()
        if at < skip:
            continue
        kind = m.lastgroup
        if kind == "space":
            yield lo + at
            start = m.end()
        elif kind == "mark":
            if at not in pairs:
                continue
            close = pairs[at]
            skip = close
            # The outermost group counts; behind its last sentence the unit may end.
            body = part[at + 1 : close].rstrip()
            tail = TAIL.search(body, max(0, len(body) - 40)) if body and not body[-1].isalnum() else None
            if tail:
                stop = at + 1 + tail.start()
                end = _behind(part, close, shutting)
                short = part[stop] == "." and tail.group()[0] == "." and _inner_abbreviation(part, stop, book)
                if not short and _after_group(part, start, at, end, part[stop]):
                    yield lo + end
                    start = skip = end
                else:
                    skip = close + 1
            else:
                skip = close + 1
        else:
            end = _behind(part, m.end(), shutting)
            if _ends(part, m.group(), at, end, book):
                yield lo + end
                start = skip = end
            else:
                skip = m.end()
    yield hi


def _inner_abbreviation(part: str, stop: int, book: Book) -> bool:
    return INVISIBLE.sub("", _word_before(part, stop)).lower() in book.all


def _list_starts(text: str, lo: int, hi: int) -> list[int]:
    """Places where list items of a paragraph begin; a marker counts at its begin, after another item, or after a colon."""
    starts, listed, last = [], True, ""
    at = lo
    while at < hi:
        line = LINE.match(text, at, hi)
        if line.end() == at:
            break
        if (listed or last.rstrip().endswith((":", "："))) and MARKER.match(text, at, hi):
            starts.append(at)
            listed = True
        elif not starts:
            listed = False
        last = line.group()
        at = line.end()
    return starts


def units(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit of a text, without the white space around it."""
    if not text:
        return []
    ends: list[int] = []
    lo, book = 0, book_of(text)
    cuts = [(m.start(), m.end()) for m in BLANK_LINE.finditer(text)] + [(len(text), len(text))]
    for stop, behind in cuts:
        if lo < stop:
            starts = _list_starts(text, lo, stop)
            if starts:
                if starts[0] > lo:
                    ends.extend(_block_units(text, lo, starts[0], book))
                ends.extend([*starts[1:], stop])
            else:
                ends.extend(_block_units(text, lo, stop, book))
        lo = behind
    out = []
    before = 0
    for e in ends:
        piece = text[before:e]
        kept = piece.rstrip()
        if kept.strip():
            out.append((before + len(piece) - len(piece.lstrip()), before + len(kept)))
        before = e
    return out


def sentence_units(documents: DataFrame) -> DataFrame:
    """doc_id, unit_no, start_pos and end_pos of each sentence unit of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, nos, starts, ends = [], [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                for k, (a, b) in enumerate(units(text)):
                    ids.append(doc), nos.append(k), starts.append(a), ends.append(b)
            yield pd.DataFrame({"doc_id": ids, "unit_no": nos, "start_pos": starts, "end_pos": ends})

    return spread(documents.select("doc_id", "text").where("text IS NOT NULL"), "doc_id").mapInPandas(run, "doc_id bigint, unit_no int, start_pos int, end_pos int")
