"""Personal data by anchor expansion.

An Aho-Corasick automaton passes once over each text and reports anchors: at-signs, plus signs,
digits, URL schemes and words that announce an account. At each anchor a small deterministic
parser expands to the left and right and validates what it found. The parsers of the base kinds
(email, ip, card, phone) give exactly the leftmost non-overlapping matches of their patterns:

* email: the local part is the run of its characters before the at-sign that no earlier match
  holds; labels after it are taken as long as a dot and a label follow.
* ip: a chain of digit runs joined by single dots is cut into fours from its start.
* card: a chain of digits with at most one space or hyphen between two of them is one match.
* phone: after a plus and a digit, the run of number characters up to its last digit.

The pass is narrow: no shuffle, no state between documents, memory bounded by a batch of texts.

Null and empty texts have no spans; null ids stay null; repeated rows each give a row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.frames import SPANS_ARROW, SPANS_DDL, map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "login")

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?i:iban)[\x20:#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?i:account|acct)(?:\x20?(?i:no|number|nr)\.?)?[\x20:#]{1,3}([0-9]{8,17})(?![0-9])")
LOGIN = re.compile(r"://([^\s/@:?#]+(?::[^\s/@?#]*)?)@[A-Za-z0-9.-]+")

#: What the automaton looks for, and the parser that each anchor calls.
ANCHORS = {
    "at": ["@"],
    "plus": ["+"],
    "digit": list("0123456789"),
    "scheme": ["://"],
    "iban": ["IBAN", "Iban", "iban"],
    "account": ["Account", "ACCOUNT", "account", "Acct", "ACCT", "acct"],
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for parser, words in ANCHORS.items():
        for word in words:
            found.add_word(word, (parser, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of one text, by start, then by kind as listed."""
    found: list[tuple[str, int, int]] = []
    email_end = dotted_end = card_end = 0
    for last, (parser, length) in anchors.iter(text):
        at = last - length + 1
        if parser == "digit":
            if at >= dotted_end:
                runs = DOTTED.match(text, at)
                dotted_end = runs.end()
                parts, begin = runs.group().split("."), at
                for i in range(0, len(parts) - 3, 4):
                    end = begin + sum(map(len, parts[i : i + 4])) + 3
                    if all(map(small, parts[i : i + 4])):
                        found.append(("ip", begin, end))
                    begin = end + 1
            if at >= card_end:
                card_end = DIGITS.match(text, at).end()
                if card_end - at >= 14:
                    digits = text[at:card_end].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        found.append(("card", at, card_end))
        elif parser == "at":
            begin = at
            while begin > email_end and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < at and (domain := DOMAIN.match(text, at + 1)):
                email_end = domain.end()
                found.append(("email", begin, email_end))
        elif parser == "plus":
            if phone := PHONE.match(text, at):
                if 10 <= sum(map(str.isdigit, phone.group())) <= 15:
                    found.append(("phone", *phone.span()))
        elif parser == "scheme":
            if login := LOGIN.match(text, at):
                found.append(("login", *login.span(1)))
        elif parser == "iban":
            if (iban := IBAN.match(text, at)) and iban_valid(iban.group(1)):
                found.append(("iban", *iban.span(1)))
        elif account := ACCOUNT.match(text, at):
            found.append(("account", *account.span(1)))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return found


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (start, rank, stop, kind), code points, by start, then by kind as listed."""

    def make():
        anchors = automaton()

        def work(_, texts: list[str]) -> list[pa.Array]:
            rows = [
                [{"start": a, "rank": KINDS.index(k), "stop": b, "kind": k} for k, a, b in spans_of(t, anchors)]
                for t in texts
            ]
            return [pa.array(rows, SPANS_ARROW)]

        return work

    return map_texts(docs, id_col, text_col, make, f"found {SPANS_DDL}")
