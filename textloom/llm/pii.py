"""Replacement of personal data by surrogates.

Entities are found in every text, and each gets a surrogate of its own type
and format: digits stay digits in the same places (a card number keeps whether
its check digit is right), letters stay letters of the same script and case, an
e-mail address stays one, and names keep their script, gender and case.
Surrogates come from a keyed hash, so the same entity has the same surrogate
everywhere, however it is spelled; a name's parts are entities, so "Anna
Weber" and "Mrs Weber" stay together. Names are found by a title or a listed
given name before them; in the same document their parts are then replaced
wherever they stand alone with a capital, before or after. Not found are names
that no such mention in their document tells, inflected forms, and names with
other letters than those of Latin-1 and Russian.

Distinct entities must stay distinct, so surrogates are checked over the whole
corpus: the distinct entities propose one each, of several that propose the
same all but one propose again, and none may propose what occurs in the corpus
as an entity itself. Where a format has too few values for that, proposals get
longer after ``SAME_LENGTH`` attempts. A secret of a few marks without a letter
or digit (``********``) is a mask and no entity. The proposals, checks and the way back to the documents
are joins on the entity; no table of entities is held in one place.

Defined results: a null text stays null and an empty one empty; rows with
equal id and text get equal results; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.tables import stage

#: Given names by gender and script, which make a capitalised word a name and tell its gender.
GIVEN = {
    ("f", "latin"): "Alice Amelia Anna Anne Barbara Carmen Caroline Catherine Charlotte Chloe Claire Clara Eleanor Elena Elizabeth Emily Emma Eva Grace Hannah Helen Ingrid Isabel Jane Jennifer Jessica Julia Karen Laura Linda Lucia Margaret Maria Marie Martha Mary Monika Nancy Olivia Patricia Petra Rachel Rebecca Rosa Ruth Sabine Sandra Sarah Sofia Sophie Susan Teresa Ursula",
    ("m", "latin"): "Adam Albert Alexander Andrew Anthony Antonio Arthur Benjamin Carlos Charles Christopher Daniel David Edward Eric Felix Francis Frank George Hans Henry Hugo Ivan Jack Jacob James Javier Jean John Jose Joseph Juan Karl Klaus Lucas Luis Manuel Mark Martin Matthew Michael Miguel Nicolas Oliver Oscar Paul Pedro Peter Philip Pierre Richard Robert Samuel Simon Stefan Thomas Walter William Wolfgang",
    ("f", "cyrillic"): "Анна Мария Ольга Елена Наталья Ирина Татьяна Светлана Екатерина Юлия",
    ("m", "cyrillic"): "Александр Сергей Дмитрий Андрей Алексей Иван Михаил Николай Владимир Павел",
}
#: Forms of address, by gender where they tell it.
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña", "m": "Mr Herr Monsieur M Señor Sr Don", "": "Dr Prof"}
#: Syllables that surrogate names are made of, and the endings of given names by gender.
SYLLABLES = {"latin": "ba be bi bo da de do fa fe ga ha jo ka ke la le li lo ma me mi mo na ne no pa ra re ri ro sa se ta te to va ve vi wa ze", "cyrillic": "ба бе ва ве га да де жа за ка ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се та те то"}
ENDINGS = {("f", "latin"): "na la ra lia tta", ("m", "latin"): "rt lf k mon ric", ("f", "cyrillic"): "на ля ра", ("m", "cyrillic"): "н р мир", ("", "latin"): "son ner ville mann", ("", "cyrillic"): "ин ов ский", ("f-last", "cyrillic"): "ина ова ская"}

GENDER = {(name, script): g for (g, script), names in GIVEN.items() for name in names.split()}
_GIVEN = "|".join(sorted((n for n, _ in GENDER), key=len, reverse=True))
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts.split()), key=len, reverse=True))
_WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)?"
_NAME = r"[A-ZÀ-ÖØ-ÞА-ЯЁ](?:[a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)?|\.)"

#: In order of precedence; each pattern starts with something rare or anchored, so long texts take linear time.
PATTERNS = [
    ("secret", re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"'<>|,;]{8,})")),
    ("secret", re.compile(r"\b((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|[0-9a-f]{40}|[0-9a-f]{64})\b")),
    ("email", re.compile(r"(?<![\w.+-])([^\W_][\w.+-]{0,63}@[^\W_][\w-]{0,62}(?:\.[\w-]{1,63}){0,6}\.[A-Za-z]{2,24})(?![\w-])")),
    ("iban", re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("ip", re.compile(r"(?<![\d.])((?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\d.]?\d)")),
    ("card", re.compile(r"(?<![\d.+-])(\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])")),
    ("ssn", re.compile(r"(?<![\d-])(\d{3}-\d{2}-\d{4})(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])(\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{2,5}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])")),
    ("name", re.compile(rf"\b((?:(?:{_TITLE})\.? )(?:{_NAME} ){{0,2}}{_WORD}|(?:{_GIVEN})(?: {_NAME}){{1,2}})(?!\w)")),
]


def script_of(word: str) -> str:
    return "cyrillic" if re.match(r"[Ѐ-ӿ]", word) else "latin"


def parts_of_name(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the parts of a name; titles stay."""
    words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\s.]+", text)]
    titles = {t: g for g, ts in TITLES.items() for t in ts.split()}
    gender, out = "", []
    if words and words[0][2] in titles:
        gender = titles[words[0][2]]
        words = words[1:]
    for i, (a, b, w) in enumerate(words):
        script = script_of(w)
        last = i + 1 == len(words)
        own = GENDER.get((w, script)) or gender
        gender = gender or own
        if len(w) == 1:
            continue
        kind = f"last:{'f' if gender == 'f' and script == 'cyrillic' else ''}:{script}" if last else f"given:{own or 'm'}:{script}"
        out.append((a, b, kind, w.lower()))
    return out


def canonical(kind: str, text: str) -> str:
    """What is the same for all spellings of an entity."""
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "phone":  # without the country code
        return re.sub(r"\D", "", re.sub(r"^\+\d{1,3}(?=[^\d])", "", text))
    if kind == "email":
        return text.lower()
    return text.replace(" ", "") if kind == "iban" else text


#: Attempts that keep the length of what they replace; then every 64 more make a proposal one character longer.
SAME_LENGTH = 127


def is_mask(secret: str) -> bool:
    """Whether it only stands for a secret: no letter or digit, and at most three different marks."""
    return len(set(secret)) <= 3 and not any(c.isalpha() or c.isdigit() for c in secret)


_CUES = {"token", "secret", "passw", "key"}
_FIRST = {n for n, _ in GENDER} | {t for ts in TITLES.values() for t in ts.split()}
_LETTERS = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]*")
_DIGITS = re.compile(r"\d{2}")
_LONG_RUN = re.compile(r"[0-9A-Za-z]{20}")


def possible(kind: str, pattern: re.Pattern, text: str) -> bool:
    """Quickly, whether a pattern could match at all."""
    if kind == "email":
        return "@" in text
    if kind == "name":
        return not _FIRST.isdisjoint(_LETTERS.findall(text))
    if pattern is PATTERNS[0][1]:
        low = text.lower()
        return any(c in low for c in _CUES)
    if pattern is PATTERNS[1][1]:
        return _LONG_RUN.search(text) is not None
    return _DIGITS.search(text) is not None


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities of a text, in order and without overlap."""
    found: list[tuple[int, int, str]] = []
    for kind, pattern in PATTERNS:
        if possible(kind, pattern, text):
            found += [(m.start(1), m.end(1), kind) for m in pattern.finditer(text)]
    taken, last = [], -1
    rank = {k: i for i, (k, _) in reversed(list(enumerate(PATTERNS)))}
    for a, b, kind in sorted(found, key=lambda x: (x[0], rank[x[2]], -x[1])):
        if a >= last:
            last = b
            if kind == "name":
                taken += [(a + x, a + y, k, c) for x, y, k, c in parts_of_name(text[a:b])]
            elif kind != "secret" or not is_mask(text[a:b]):
                taken.append((a, b, kind, canonical(kind, text[a:b])))
    return taken


_CAPITALISED = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-ÞА-ЯЁ]\w+(?:-\w+)*")


def with_bare_names(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The entities of a text and the parts of its names where they stand alone; a part of several types is of the latest before it, or else of the first."""
    known: dict[str, str] = {}
    for _, _, kind, form in found:
        if ":" in kind:
            known.setdefault(form, kind)
    if not known:
        return found
    out, at, n = [], 0, len(found)
    for m in _CAPITALISED.finditer(text):
        a, b = m.span()
        while at < n and found[at][1] <= a:
            out.append(found[at])
            if ":" in found[at][2]:
                known[found[at][3]] = found[at][2]
            at += 1
        whole = m[0].lower()
        pieces = [(a, b, whole)] if whole in known or "-" not in whole else [(a + x.start(), a + x.end(), x[0].lower()) for x in re.finditer(r"[^-]+", m[0]) if x[0][0].isupper()]
        free = at == n or found[at][0] >= b
        out += [(x, y, known[w], w) for x, y, w in pieces if free and w in known]
    return out + found[at:]


def luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


class Stream:
    """Keyed numbers for one entity and one attempt."""

    def __init__(self, key: bytes, kind: str, form: str, attempt: int) -> None:
        self.key, self.seed, self.block = key, f"{kind}\0{form}\0{attempt}".encode(), 0
        self.left = b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.digest(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256)
            self.block += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """Characters of the same class, script and case."""
        out = []
        for c in text:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif "Ѐ" <= c <= "ӿ":
                x = chr(0x430 + self.below(32))
                out.append(x.upper() if c.isupper() else x)
            elif c.isalpha():
                x = "abcdefghijklmnopqrstuvwxyz"[self.below(26)]
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, form: str, attempt: int) -> str:
    """A proposal, in canonical form. Later attempts are a little longer, where the format leaves few values."""
    s = Stream(key, kind, form, attempt)
    more = "0" * (0 if attempt < SAME_LENGTH else 1 + (attempt - SAME_LENGTH) // 64)
    if kind == "email":
        local, domain = form.split("@", 1)
        site = Stream(key, "domain", domain, 0).like(domain.rsplit(".", 1)[0])
        return s.like(local) + ("" if attempt < 4 else str(s.below(10 ** min(9, attempt)))) + "@" + site + ".example"
    if kind == "ip" and more:  # addresses for documentation, of the longer kind
        return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
    if kind == "ip":
        return f"10.{s.below(256)}.{s.below(256)}.{s.below(256)}" if attempt < 8 else f"{1 + s.below(223)}.{s.below(256)}.{s.below(256)}.{s.below(256)}"
    if kind == "card":
        body = s.like(form[:-1] + more)
        valid = luhn(form) == 0
        right = (10 - luhn(body + "0")) % 10
        return body + str(right if valid else (right + 1 + s.below(9)) % 10)
    if kind == "iban":
        return form[:2] + s.like(form[2:] + more)
    if kind in ("given", "last") or ":" in kind:
        part, gender, script = kind.split(":")
        pick = lambda xs: xs[s.below(len(xs))]
        syllables = SYLLABLES[script].split()
        ends = ENDINGS.get((gender if part == "given" else ("f-last" if gender == "f" else ""), script)) or ENDINGS[("", script)]
        return "".join(pick(syllables) for _ in range(2 + s.below(2) + attempt // 3)) + pick(ends.split())
    if not any(c.isalpha() or c.isdigit() for c in form):  # marks stay as they are, so a secret of marks gets letters
        form = "x" * len(form)
    return s.like(form + more, hexadecimal=kind == "secret" and re.fullmatch(r"[0-9a-f]+", form) is not None)


def rendered(kind: str, surface: str, new: str) -> str:
    """A surrogate in the format of what it replaces."""
    if kind in ("card", "ssn", "phone", "iban"):
        old = [i for i, c in enumerate(surface) if c.isalnum()]
        old = old[len(old) - len(canonical(kind, surface)) :]  # a country code that isn't part of the canonical form stays
        out = list(surface)
        for i, c in zip(old, new, strict=False):
            out[i] = c
        out[old[-1]] += new[len(old) :]
        return "".join(out)
    if ":" in kind:
        return new.upper() if surface.isupper() and len(surface) > 1 else "-".join(x.capitalize() for x in new.split("-")) if surface[:1].isupper() else new
    return new


def mentions(docs: DataFrame) -> DataFrame:
    """(id, copy, kind, form): the distinct entities of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, forms = [], [], []
            for i, text in enumerate(batch.column(1)):
                for kind, form in sorted({(k, c) for _, _, k, c in entities(text.as_py() or "")}):
                    at.append(i)
                    kinds.append(kind)
                    forms.append(form)
            index = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(2).take(index), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["id", "copy", "kind", "form"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, copy int, kind string, form string")


def proposals(wanted: DataFrame, key: bytes, attempts: range) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(k, f, n, surrogate(key, k, f, n)) for k, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for n in attempts]
            kinds, forms, at, new = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(forms, pa.string()), pa.array(at, pa.int32()), pa.array(new, pa.string())], ["kind", "form", "attempt", "new"])

    return wanted.select("kind", "form").mapInArrow(run, "kind string, form string, attempt int, new string")


def assigned(forms: DataFrame, key: bytes, most_rounds: int = 30) -> DataFrame:
    """(kind, form, new): a surrogate for each distinct entity; no two of a type share one, and none is an entity of the corpus.

    Each round those that are left propose more at once, up to 64, so that
    formats with few values are filled too.
    """
    left, done, at = forms, None, 0
    for i in range(most_rounds):
        attempts = range(at, at + (1 << min(i, 6)))
        at = attempts.stop
        free = proposals(left, key, attempts).join(forms.select("kind", F.col("form").alias("new")), ["kind", "new"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        won = free.groupBy("kind", "new").agg(F.min(F.struct("form", "attempt")).alias("w")).select("kind", "new", "w.*")
        won = won.groupBy("kind", "form").agg(F.min_by("new", "attempt").alias("new"))
        done = stage(won if done is None else done.unionByName(won), "pii_surrogates")
        left = stage(forms.join(done, ["kind", "form"], "left_anti"), "pii_left")
        if left.isEmpty():
            return done
    raise RuntimeError(f"entities are left without a surrogate after {at} proposals each")


def replaced(met: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = [], []
            for text, known in zip(batch.column(1), batch.column(2), strict=True):
                text, known = text.as_py(), known.as_py()
                own, out, at, length = [], [], 0, 0
                if known:
                    new = {(x["kind"], x["form"]): x["new"] for x in known}
                    for a, b, kind, form in with_bare_names(text, entities(text)):
                        put = rendered(kind, text[a:b], new[kind, form])
                        out += [text[at:a], put]
                        length += a - at
                        own.append({"kind": kind.split(":")[0], "start": length, "end": length + len(put)})
                        length += len(put)
                        at = b
                    out.append(text[at:])
                    text = "".join(out)
                texts.append(text)
                spans.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, span)], ["id", "text", "entities"])

    return met.mapInArrow(run, f"id {met.schema['id'].dataType.simpleString()}, text string, entities array<struct<kind: string, start: long, end: long>>")


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, entities) of every document: the text with surrogates, and where they are."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.hash(text_col).alias("copy"))
    said = stage(mentions(docs), "pii_mentions")
    new = assigned(stage(said.select("kind", "form").distinct(), "pii_forms"), key)
    known = said.join(new, ["kind", "form"]).groupBy("id", "copy").agg(F.collect_set(F.struct("kind", "form", "new")).alias("known"))
    known = known.select(F.col("id").alias("k_id"), F.col("copy").alias("k_copy"), "known")
    met = docs.join(known, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("copy") == F.col("k_copy")), "left")
    return replaced(met.select("id", "text", "known")).withColumnRenamed("id", id_col)
