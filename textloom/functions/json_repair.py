"""JSON whose texts hold quotes that nobody escaped."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = re.compile(r"[ \t\r\n]*")
#: A key behind a comma: up to the next quote, and its colon.
_KEY = re.compile(r'"(?:[^"\\]|\\.)*"[ \t\r\n]*:', re.S)
_VALUE = re.compile(r'["{\[\-0-9]|true|false|null')
_ASIAN = re.compile("[㐀-䶿一-鿿豈-﫿、。〈-】！（），：；？]")
#: What stands for a stray quote between letters of Chinese.
CURLY = "“"


def parses(text: str) -> bool:
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


def _ends(text: str, at: int, open_: list[str], is_key: bool) -> bool:
    """Whether the quote before ``at`` ends its string: what follows must go on as JSON does, given the containers that are open."""
    at = _BLANK.match(text, at).end()
    if is_key:
        return text[at : at + 1] == ":"
    for depth in range(len(open_), 0, -1):
        c = text[at : at + 1]
        if c == ",":
            behind = _BLANK.match(text, at + 1).end()
            return bool((_KEY if open_[depth - 1] == "{" else _VALUE).match(text, behind))
        if c != {"{": "}", "[": "]"}[open_[depth - 1]]:
            return False
        at = _BLANK.match(text, at + 1).end()
    return at == len(text)


def mended(text: str, curly: bool = False) -> str:
    """The text with its stray quotes escaped, or between Chinese letters curled; as it is if it parses already, or if that doesn't help.

    One pass with a stack of open containers, which tells keys from values.
    Inside a string a quote is stray unless the text goes on behind it as JSON
    would: a key with its colon, a value with a comma and the next key or
    value, or with the end of what holds it.
    """
    if parses(text):
        return text
    out, open_, at, inside, is_key, expects_key = [], [], 0, False, False, False
    while at < len(text):
        c = text[at]
        if inside and c == "\\":
            out.append(text[at : at + 2])
            at += 2
            continue
        if c == '"' and not inside:
            inside, is_key = True, expects_key
        elif c == '"':
            if _ends(text, at + 1, open_, is_key):
                inside = False
            else:
                asian = curly and (_ASIAN.match(text, at - 1) or _ASIAN.match(text, at + 1))
                c = CURLY if asian else '\\"'
        elif not inside and c in "{[":
            open_.append(c)
            expects_key = c == "{"
        elif not inside and c in "}]" and open_:
            open_.pop()
            expects_key = False
        elif not inside and c in ",:":
            expects_key = c == "," and open_[-1:] == ["{"]
        out.append(c)
        at += 1
    made = "".join(out)
    return made if parses(made) else text


def json_mended(c: Column, curly: bool = False) -> Column:
    """``mended`` of a column."""

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else mended(x, curly))

    return F.pandas_udf(each, "string")(c)
