"""HTML paragraphs of a sitting as turns, notes, headings and page matter.

A document's paragraphs are read in order by one small automaton.  Paragraphs are cut
first (``pieces``), so that each holds one thing; then rules are tried in order
(``Reader.RULES``): the first whose test holds files the paragraph and may change the
state: who speaks, which turn, which chapter, whether a note or an insertion runs.

Labels are read by one grammar over the paragraph's characters and which of them are
bold (``label_at``): title or office, name, holder in parentheses, terminator.

``turns`` runs the automaton in Arrow batches, a document at a time; what neighbours
decide afterwards (``consolidated``, dense turn numbers) is done by windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.functions import fixed
from turnstone.sources.html import paragraphs_of

UPPER = "A-ZÁÉÍÓÚÑÜ"
DASH = r"[-–—]{1,2}"
TITLE = r"(?i:Sr|Sra|Srta|Sres)(?:(?:\s*[.\-]\s*)+|\s+)|S\s+r\.\s*|(?i:Varios señores|Varias señoras|Un señor|Una señora)\s+"
WORDS = r"[^\s.,;:()]+(?:\s+[^\s.,;:()]+){0,4}"
HOLDER = r"\s*\((?P<holder>[^()]{1,60}?)(?P<shut>\)|(?=\s*[.,]\s*[-–—]))"
LABEL = re.compile(rf"(?P<title>{TITLE})?(?P<name>{WORDS})(?P<stray>\s*[^\s()]{{1,2}}(?=\s*\())??(?:{HOLDER})?")
ENDS = re.compile(rf"(?P<dash>\s*[.,;:]*\s*{DASH}[.,;:]*\s*)|(?P<stop>\s*[.,]+\s*(?=[¿¡(\"«{UPPER}]))|(?P<none>(?<=\))\s+(?=[¿¡{UPPER}]))")
AGAIN = re.compile(rf"\((?P<holder>[^)]{{1,40}})\)\s*[.,;:]*\s*{DASH}\s*")
WORD = re.compile(r"\w")
LEADING = re.compile(r"^[\s.\-–—…]*")
DASHED = re.compile(r"^\s*[-–—−]+\s*")


def event_kind(text: str) -> str:
    """The kind of a note, without its opening dash."""
    low = DASHED.sub("", text).lower()
    return next((name for name, pattern in fixed.EVENT_SUBTYPES if re.search(pattern, low)), "unspecified")


@dataclass(frozen=True)
class Para:
    """A paragraph's characters, which of them are bold and italic, and where it stands."""

    chars: str
    bold: tuple[bool, ...]
    italic: tuple[bool, ...]
    center: bool = False
    multicol: bool = False
    listitem: bool = False
    after_rule: bool = True
    link_only: bool = False
    small: bool = False

    @classmethod
    def of(cls, p: dict) -> Para:
        spread = lambda k: tuple(r[k] for r in p["runs"] for _ in r["text"])
        return cls("".join(r["text"] for r in p["runs"]), spread("bold"), spread("italic"), *(p[f] for f in ("center", "multicol", "listitem", "after_rule", "link_only", "small")))

    @property
    def text(self) -> str:
        return " ".join(self.chars.split())

    def part(self, begin: int, end: int | None = None, **change) -> Para:
        return replace(self, chars=self.chars[begin:end], bold=self.bold[begin:end], italic=self.italic[begin:end], **change)

    def share(self, mask: tuple[bool, ...]) -> float:
        own = [m for c, m in zip(self.chars, mask) if not c.isspace()]
        return sum(own) / len(own) if own else 0.0


@dataclass(frozen=True)
class Label:
    name: str
    begin: int
    speech: int


def label_at(p: Para, at: int = 0) -> Label | None:
    """The label that begins here, or None.

    With a title, a dash must end it, or a stop if all of it is bold and the name short, or nothing at
    all after a bold label's holder.  Without one, an office with its holder, or a shouted name,
    must be bold throughout and end in a dash.
    """
    m = LABEL.match(p.chars, at)
    while m and m["name"]:
        name, end = " ".join(m["name"].split()), m.end()
        last = name.rsplit(" ", 1)[-1].lower()
        stop = ENDS.match(p.chars, end)
        head = p.bold[m.start() : m.start("holder") - 1 if m["holder"] else end]
        if m["stray"]:
            given = last + m["stray"].strip().lower()
            name = name + m["stray"].strip() if given in fixed.OFFICES else name if last in fixed.OFFICES else None
        if stop and name:
            untitled = not m["title"]
            short = len(name.split()) <= 2
            bold_all, bold_any = bool(head) and all(head), any(p.bold[m.start() : stop.end()])
            if untitled:
                fits = bool(stop["dash"]) and bold_all and (m["holder"] and last in fixed.OFFICES or bool(re.fullmatch(rf"[{UPPER}]{{2,}}(?:\s+[{UPPER}]{{2,}}){{0,2}}", name)))
            else:
                fits = bool(stop["dash"]) and (bold_any or at == 0) or bool(stop["stop"]) and bold_all and short or bool(stop["none"]) and bold_any and bool(m["holder"])
            if fits:
                title = re.sub(r"\s+", " ", m["title"] or "").strip()
                title = re.sub(r"^S r\.", "Sr.", re.sub(r"\s+\.", ".", title))
                holder = m["holder"]
                rest = AGAIN.match(p.chars, stop.end()) if not holder else None
                holder, speech = (rest["holder"], rest.end()) if rest else (holder, stop.end())
                out = " ".join(filter(None, [title, name.rstrip(".")])) + (f" ({holder.strip()})" if holder else "")
                return Label(out, m.start(), speech)
        # A shorter name may end where this one ran on.
        shorter = name.rsplit(" ", 1)[0] if name and " " in name else ""
        m = re.compile(rf"(?P<title>{TITLE})?(?P<name>{re.escape(shorter)})(?P<stray>$^)?(?:{HOLDER})?").match(p.chars, at) if shorter else None
    return None


def opening_label(p: Para) -> Label | None:
    """The label that a paragraph opens with; dashes and dots before it are passed over if some of it is bold."""
    begin = LEADING.match(p.chars).end()
    found = label_at(p, begin) if re.match(fixed.SPEAKER, p.chars[begin:].lstrip()) or any(p.bold[begin : begin + 40]) else None
    if found is None or begin and p.chars[:begin].strip() and not any(p.bold[begin : found.speech]):
        return None
    return found


def pieces(p: Para) -> Iterator[Para]:
    """A paragraph cut where a title and a label are welded, and at labels inside it."""
    weld = re.match(r"(?i)\s*(?:Orden del D[íi]a|Dictamen|Expediente)[^\n]{0,40}?\d(?=(?:Sr|Sra|Srta|Sres)\.?\s*[^\W\d_])", p.chars)
    if weld and any(p.bold[: weld.end()]):
        yield p.part(0, weld.end(), center=True)
        p = p.part(weld.end(), center=False)
    at = 1
    while m := re.compile(rf"(?<=[.?!:…)»\"a-záéíóúñ])\s*[-–—]?\s*(?={TITLE})").search(p.chars, at):
        at = m.end() + 1
        before = p.chars[: m.start()]
        label = label_at(p, m.end())
        welded = m.start() > 0 and p.chars[m.start() - 1].isalpha()
        whole = label is not None and all(p.bold[m.end() : label.speech - 1][:4])
        if not WORD.search(before) or re.search(r"\b(?i:Sr|Sra|Srta|Sres)\s*[.\-]?\s*$", before) or label is None:
            continue
        if not any(p.bold[m.end() : label.speech]) or welded and (p.bold[m.start() - 1] or not whole) or not WORD.search(p.chars[label.speech :]):
            continue
        yield p.part(0, m.start())
        p, at = p.part(m.start(), center=False), label.speech - m.start() + 1
    yield p


def spoken_then_noted(p: Para) -> int | None:
    """Where a finished sentence ends and an italic note in brackets begins, in one paragraph."""
    begin = next((k for k, (c, i) in enumerate(zip(p.chars, p.italic)) if i and not c.isspace()), None)
    if begin is None:
        return None
    if p.chars[:begin].rstrip().endswith("("):
        begin = p.chars[:begin].rstrip().rindex("(")
    said = p.chars[:begin].strip()
    fits = p.chars[begin:].lstrip().startswith("(") and not re.match(r"[-–—(]", said) and len(re.findall(r"\w+", said)) >= 2 and re.search(r"[.!?…]$", said)
    return begin if fits else None


def noted_then_printed(p: Para) -> int | None:
    """Where an italic note that announces a document ends and the document begins, in one paragraph."""
    end = next((k for k, (c, i) in enumerate(zip(p.chars, p.italic)) if not i and WORD.match(c)), None)
    if not end or not any(p.italic[:end]) or not re.search(fixed.DOCUMENT_FOLLOWS, p.chars[:end]):
        return None
    return end


class Reader:
    """The automaton: each rule is a method that files the paragraph, or gives False."""

    RULES = ("page_matter", "navigation", "roll", "centred_label", "heading", "labelled", "signature", "document_note", "sentence_and_note", "note", "second_note", "stray_stop", "back_from_insertion", "goes_on", "unattributed")

    def __init__(self, paragraphs: list[dict]):
        self.rows: list[dict] = []
        self.speaker = self.chapter = self.number = self.inserted_by = None
        self.turn = 0
        self.in_roll = self.noted = self.follows = self.insertion_small = False
        self.titles: dict[str, str] = {}
        paras = [q for p in paragraphs for q in pieces(Para.of(p)) if q.text]
        for k, p in enumerate(paras):
            self.follows, self.noted = self.noted, False
            self.later = next((q.text for q in paras[k + 1 :] if WORD.search(q.text)), "")
            next(rule for rule in self.RULES if getattr(self, rule)(p) is not False)

    def file(self, kind: str, text: str, **more) -> None:
        row = {"type": kind, "text": text, "chapter": None if kind == "furniture" else self.chapter, "event_type": None, "turn_id": None, "speaker_raw": None, "font_style": None}
        self.rows.append(row | more)

    def say(self, text: str) -> None:
        self.file("speech", text, turn_id=self.turn, speaker_raw=self.speaker, font_style="normal")

    def announce(self, text: str, style: str = "italic") -> None:
        self.file("event", text, event_type=event_kind(text), font_style=style)

    def page_matter(self, p):
        if not (p.multicol or p.listitem or not p.after_rule):
            return False
        self.file("furniture", p.text)
        self.speaker = None

    def navigation(self, p):
        pointer = re.match(r"^\s*(?:\d+\s*[.)]?\s*Ver el Ap[ée]ndice\s*\.?|(?:[^\n]{0,60}\s)?(?:Sub)?[Dd]irector(?:a)?\s+(?:a/c\s+)?del\s+Cuerpo\s+de\s+Taqu[íi]grafos)\s*$", p.text)
        back = re.search(r"(?i)volver al sumario|^\s*\[?\s*sumario\s*\]?\s*$", p.text)
        if not (p.link_only or pointer or back and opening_label(p) is None):
            return False
        self.file("furniture", p.text)

    def roll(self, p):
        if re.match(rf"^(?:{fixed.ROLL_HEADINGS})\b[^a-záéíóúñü]*$", p.text):
            self.in_roll = True
        elif not re.match(rf"^[{UPPER}][{UPPER}'’.\s]+,\s*[{UPPER}][a-záéíóúñü]", p.text):
            self.in_roll = False
        if not self.in_roll:
            return False
        self.file("furniture", p.text)
        self.speaker = None

    def take_floor(self, p, label):
        self.speaker, self.turn = label.name, self.turn + 1
        self.say(re.sub(r"(?i)\s*\[?\s*volver al sumario\s*\]?\s*", " ", " ".join(p.chars[label.speech :].split())).strip())

    def centred_label(self, p):
        label = opening_label(p) if p.center else None
        if label is None or not WORD.search(p.chars[label.speech :]):
            return False
        self.inserted_by = None
        self.take_floor(p, label)

    def heading(self, p):
        if not p.center:
            return False
        self.inserted_by = self.speaker = None
        chapter, own = None, self.number
        self.number = None
        if re.fullmatch(r"\d{1,3}", p.text):
            self.number = p.text
        elif own is not None:
            self.chapter = chapter = own
            self.titles[own] = f"{own} {p.text}"
        self.file("heading", p.text, chapter=chapter)

    def labelled(self, p):
        label = opening_label(p)
        if label is None:
            return False
        self.take_floor(p, label)

    def signature(self, p):
        if len(p.text.split()) > 5 or not re.match(fixed.SIGN_OFF, self.later):
            return False
        self.file("furniture", p.text)
        self.speaker = None

    def insert(self):
        self.inserted_by, self.insertion_small, self.speaker = self.speaker, False, None

    def document_note(self, p):
        at = noted_then_printed(p)
        if at is None:
            return False
        self.announce(p.part(0, at).text)
        self.file("other", p.part(at).text)
        self.insert()

    def sentence_and_note(self, p):
        at = spoken_then_noted(p) if p.share(p.italic) >= 0.6 else None
        if at is None:
            return False
        said = p.part(0, at).text
        if self.speaker is None:
            self.file("other", said)
        else:
            self.say(said)
        self.announce(p.part(at).text)
        self.noted = True

    def note(self, p):
        marked = re.match(r"\s*(?:[-–—(\[_]|\.\.)", p.text) or re.match(rf"\s*(?:{fixed.NOTE_OPENINGS})", p.text) or p.text.endswith(")")
        if p.share(p.italic) < 0.6 or not (self.follows or marked or event_kind(p.text) != "unspecified" or self.speaker is None):
            return False
        self.announce(p.text)
        if re.search(fixed.DOCUMENT_FOLLOWS, p.text) or re.match(fixed.READ_OUT, p.text):
            self.insert()
        self.noted = True

    def second_note(self, p):
        if not self.follows or not re.match(rf"\s*-{{1,2}}\s*[{UPPER}]", p.text):
            return False
        self.announce(p.text, "normal")
        self.noted = True

    def stray_stop(self, p):
        if not self.follows or WORD.search(p.text):
            return False
        self.file("furniture", p.text)

    def back_from_insertion(self, p):
        if self.speaker is None and self.inserted_by is not None:
            if p.small:
                self.insertion_small = True
            elif self.insertion_small and re.match(r"(?i)\s*Se[ñn]or[a]?\s+president[ae]\b", p.text):
                self.speaker, self.inserted_by = self.inserted_by, None
        return False

    def goes_on(self, p):
        if self.speaker is None:
            return False
        self.say(p.text)

    def unattributed(self, p):
        self.file("other", p.text)


def joined_turns(rows: list[dict]) -> list[dict]:
    """Neighbouring speech of one turn as one row."""
    out: list[dict] = []
    for r in rows:
        if out and r["type"] == out[-1]["type"] == "speech" and r["turn_id"] == out[-1]["turn_id"]:
            out[-1]["text"] = f"{out[-1]['text']} {r['text']}".strip()
        else:
            out.append(dict(r))
    return out


EMBEDDED = re.compile(r"(?:(?<=[.!?:…)\]»”\"])\s+|(?<=\S)\s{2,})((?:[─—–]|--)\s*[A-ZÁÉÍÓÚÑ][^─—–]{0,250}?(?:\.\.\.|[.:)…]))(?=\s|$)")


def chair_goes_on(speaker: str | None, text: str) -> bool:
    """Whether the chair, cut off by a printed list, takes the paragraph back."""
    return bool(speaker and re.search("(?i)president", speaker) and re.match(fixed.CHAIR_GOES_ON, text))


def notes_out_of_speech(rows: list[dict]) -> list[dict]:
    """Notes printed in roman inside a speech become rows; one that announces a text ends the turn until the chair goes on."""
    out, ended = [], None
    for r in rows:
        if r["type"] != "speech":
            out.append(r)
            continue
        nobody = {"type": "other", "turn_id": None, "speaker_raw": None, "font_style": None}
        if ended is not None and r["turn_id"] == ended and not chair_goes_on(r["speaker_raw"], r["text"]):
            out.append(r | nobody)
            continue
        ended, at = None, 0
        for m in EMBEDDED.finditer(r["text"]):
            note = m[1].strip()
            plain = re.sub(r"^(?:[─—–]|--)\s*", "", note)
            announces = bool(re.search(fixed.DOCUMENT_FOLLOWS, note))
            if not announces and not (re.match(fixed.EMBEDDED_KINDS, plain) and len(plain.split()) <= 30):
                continue
            out += [r | {"text": r["text"][at : m.start(1)]}, r | {"type": "event", "text": note, "turn_id": None, "speaker_raw": None, "event_type": event_kind(plain)}]
            at = m.end(1)
            if announces:
                ended = r["turn_id"]
                break
        out.append(r | {"text": r["text"][at:]} | (nobody if ended is not None else {}))
    return [r | {"text": r["text"].strip()} for r in out if r["type"] != "speech" or WORD.search(r["text"])]


RESIDUE = re.compile(r"^\s*(?:[.,](?![.])\s*[─—–\-]{0,2}|[─—–\-]{1,2})\s*(?=[¿¡\"“«(A-ZÁÉÍÓÚÑ])")


def without_residue(rows: list[dict]) -> list[dict]:
    """The first speech of each turn without a stray terminator before it."""
    seen: set = set()
    for r in rows:
        if r["type"] == "speech" and r["turn_id"] not in seen:
            seen.add(r["turn_id"])
            r["text"] = RESIDUE.sub("", r["text"], count=1)
    return rows


def turns_of(markup: str | None) -> tuple[list[dict], dict[str, str]]:
    """A document's rows in order, and its chapters' titles."""
    reader = Reader(paragraphs_of(markup))
    rows = without_residue(notes_out_of_speech(joined_turns(reader.rows)))
    return [r for r in rows if r["text"].strip()], reader.titles


TURNS = "seq long, type string, event_type string, turn_id long, chapter string, chapter_title string, speaker_raw string, text string, font_style string, error string"


def turns(docs: DataFrame, doc: str, markup: str) -> DataFrame:
    """The rows of each document (``doc``, ``markup``); a document that cannot be read gives one row with its error."""
    kind = dict(docs.dtypes)[doc]
    names = [c.split()[0] for c in TURNS.split(", ")]

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1).to_pylist()):
                try:
                    rows, titles = turns_of(text)
                    rows = [r | {"seq": n, "chapter_title": titles.get(r["chapter"]), "error": None} for n, r in enumerate(rows)]
                except Exception as fault:  # one document's fault is its own
                    rows = [dict.fromkeys(names) | {"seq": 0, "error": f"{type(fault).__name__}: {fault}"}]
                if rows:
                    columns = [pa.array([key.as_py()] * len(rows), batch.column(0).type)]
                    columns += [pa.array([r[n] for r in rows], pa.int64() if n in ("seq", "turn_id") else pa.string()) for n in names]
                    yield pa.RecordBatch.from_arrays(columns, [doc, *names])

    return docs.select(doc, markup).mapInArrow(run, f"`{doc}` {kind}, {TURNS}")
