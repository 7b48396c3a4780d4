"""Personal data by a semi-Markov conditional random field over whole spans.

Base spans are those that fixed patterns find, leftmost and without overlap for each kind; what fails
the kind's check is dropped. They always stay. The model adds spans in the text between them: numbers
with other separators or none, numbers that are named in the words before, addresses of version 6,
emails spelled out.

* **Zones.** Only stretches that can hold such a span are looked at: runs of digits and separators
  with at least seven digits, surroundings of an "at", runs of hexadecimal digits with colons. All else is
  outside of spans by definition, so zones are decided one by one without loss.
* **Segments.** A zone is cut into tokens (digits, letters, white space, single signs). Every run of up
  to ``MAX_TOKENS`` tokens that could be of a kind is a candidate segment; it is described as a whole: its
  shape by groups, check digits, parts that read as dates or years, its signs, what touches it, and the words
  before it.
* **Decision.** The field scores a division of the zone into segments and single outside tokens by its
  segments' features and neighbouring labels. Training maximizes the probability of the labelled
  division (forward and backward sums over all divisions); decoding takes the best one by dynamic
  programming over segments of bounded length, so boundaries and kinds are chosen together.

``train`` learns from any labelled texts, at most ``MAX_ROWS`` of them in one task; ``findings`` makes a
stated set. ``scan`` is one narrow stage. A text of any length is read whole; work grows with its length,
as patterns are without backtracking over long runs and segments are bounded.

Offsets are code points, ends exclusive. Null and empty texts have no spans, repeated rows are found alike,
an empty table gives an empty result, keys aren't read. Columns named like the results are replaced.
"""

from __future__ import annotations

import ipaddress
import math
import pickle
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from headway.llm._common import importable, without

KINDS = ("email", "ip", "card", "phone")
#: Tokens of a segment at most; labelled texts learned from at most; passes over them.
MAX_TOKENS, MAX_ROWS, PASSES = 40, 800, 25
SPANS = "array<struct<kind string, start int, end int>>"

LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL, _EMAIL_HERE = re.compile(rf"(?<![{LOCAL}])[{LOCAL}]++@{_DOMAIN}"), re.compile(rf"[{LOCAL}]++@{_DOMAIN}")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(text) and text.find("@", at) >= 0:
        # Right behind a match, one may begin within a run of the same signs.
        found = (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind and start."""
    spans = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


# --- zones, tokens and candidate segments -------------------------------------------------------------

_NUMBER_ZONE = re.compile(r"(?<![0-9A-Za-z])(?:\+|\(|\(\+)?[0-9](?:[\x20\xa0().,/:-]{0,3}[0-9])*+")
_MARK = re.compile(r"@|[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT) (?=[\w-]+ (?:dot|DOT|punkt|punto|point) )")
_AFTER_MARK = re.compile(r" ?[\w-]{1,63}+(?:(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT|punkt|punto|point) )[\w-]{1,63}+)+")
_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
_WORDS = re.compile(r"[^\W\d_]+|[€$£%#]")
#: Longest address of version 6 as text, least digits of a number, characters before a segment that are looked at.
_IP6_CHARS, _LEAST_DIGITS, _BEFORE = 39, 7, 32
#: Most digits and groups of a number.
_MOST_DIGITS, _MOST_GROUPS = 19, 6
#: Words that name a kind, or something harmless.
NAMED = {
    "phone": "tel telephone phone call mobile cell fax ring whatsapp téléphone portable appel appelez telefon handy anruf mobil rufnummer teléfono móvil llame llamar",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta crédito kartennummer",
    "ip": "ip ipv6 address host server client addr adresse dirección ping from",
    "email": "email mail e contact write correo courriel kontakt schreiben contacto",
    "harmless": "version order isbn ref invoice date page pages no nr id ticket issue article total price tracking serial commande rechnung bestellung pedido factura datum fecha prix seite página amount population build year code # € $ £ %",
}
_NAMED = {word: kind for kind, words in NAMED.items() for word in words.split()}


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches that can hold a span, in order and apart from each other."""
    found = []
    for m in _NUMBER_ZONE.finditer(text):
        if m.end() - m.start() >= _LEAST_DIGITS and len(_NOT_DIGITS.sub("", m[0])) >= _LEAST_DIGITS:
            found.append(m.span())
    for m in _MARK.finditer(text):
        behind = _AFTER_MARK.match(text, m.end())
        if behind:
            low = max(0, m.start() - 66)
            start = m.start()
            while start > low and (text[start - 1].isalnum() or text[start - 1] in "_.+-" or (start == m.start() and text[start - 1] == " ")):
                start -= 1
            if text[start:m.start()].strip():
                found.append((start, behind.end()))
    end = 0
    for m in _COLONS.finditer(text):
        if m.start() < end:
            continue
        start, end = m.start(), m.end()
        while start > 0 and end - start <= _IP6_CHARS and text[start - 1] in "0123456789abcdefABCDEF:":
            start -= 1
        while end < len(text) and end - start <= _IP6_CHARS and text[end] in "0123456789abcdefABCDEF:":
            end += 1
        if end - start <= _IP6_CHARS:
            found.append((start, end))
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _between(zone: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Zones without what base spans cover."""
    taken, parts, i = sorted((s, e) for _, s, e in base), [], 0
    for start, end in zone:
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        j = i
        while j < len(taken) and taken[j][0] < end:
            if taken[j][0] > start:
                parts.append((start, taken[j][0]))
            start = max(start, taken[j][1])
            j += 1
        if start < end:
            parts.append((start, end))
    return parts


def _kinds(body: str) -> tuple[str, ...]:
    """The kinds that a stretch could be of."""
    if re.search(r"@|\b(?:at|AT)\b", body):
        return ("email",) if re.search(r"\.|\b(?:dot|DOT|punkt|punto|point)\b", body) and body[-1].isalnum() and (body[0].isalnum() or body[0] == "_") else ()
    if body.count(":") >= 2 and not body.strip("0123456789abcdefABCDEF:"):
        return ("ip",)
    if body[-1] in "0123456789" and body[0] in "0123456789+(" and not body.strip("0123456789 \xa0().,/:+-") and len(_NOT_DIGITS.split(body.strip("+("))) <= _MOST_GROUPS:
        n = len(_NOT_DIGITS.sub("", body))
        return (*(("phone",) if _LEAST_DIGITS <= n <= 15 else ()), *(("card",) if 12 <= n <= 19 else ()))
    return ()


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    """What a whole segment looks like, as a kind."""
    body, behind = text[start:end], text[end:end + 2]
    near = _WORDS.findall(text[max(0, start - _BEFORE):start].lower())[-3:]
    named = [_NAMED.get(w) for w in near]
    out = ["any"]
    out += [f"named {n}" for n in set(named) if n] + ([f"right before {named[-1]}"] if named and named[-1] else ["no name before"] if not any(named) else [])
    touched = text[start - 1:start] + "|" + behind[:1]
    if start and text[start - 1] in ".,-/:=#$€£_":
        out.append("touched before")
    if re.match(r"[%€$£°/_=-]|[.,:]\d", behind) or re.match(r" ?(?:%|€|km|kg|EUR|USD)", text[end:end + 5]):
        out.append("touched behind")
    if '"' in touched or "'" in touched:
        out.append("quoted")
    if kind == "email":
        spelled = re.search(r"[\[({<] ?(?:at|AT|@)", body)
        out.append("bracketed at" if spelled else "sign at" if "@" in body else "worded at")
        out.append("spelled dot" if re.search(r"\b(?:dot|DOT|punkt|punto|point)\b", body) else "sign dot")
        out.append("blank" if " " in body else "no blank")
        last = re.split(r"[^\w-]+", body)[-1]
        out.append("short ending" if 2 <= len(last) <= 3 and last.isalpha() else "letters at end" if last.isalpha() else "odd ending")
        return [f"{kind} {f}" for f in out]
    if kind == "ip":
        try:
            ipaddress.IPv6Address(body)
            out.append("valid address")
        except ValueError:
            out.append("no address")
        out.append(f"groups {min(8, body.count(':'))}")
        out.append("letters" if re.search("[a-fA-F]", body) else "digits only")
        return [f"{kind} {f}" for f in out]
    digits, groups = _NOT_DIGITS.sub("", body), re.findall("[0-9]+", body)
    signs = set(re.findall(r"[^0-9]", body))
    n = len(digits)
    out.append(f"digits {n}")
    out.append(f"groups {len(groups)}" if len(groups) < 6 else "many groups")
    out.append("shape " + "-".join(str(len(g)) for g in groups[:6]) if len(groups) > 1 else "one run")
    out += [f"sign {s}" for s in sorted(signs & set(".,/:"))]
    out.append("one sign" if len(signs - set("+()")) == 1 else "no sign" if not signs - set("+()") else "mixed signs")
    out.append("plus" if body[0] == "+" else "double zero" if body.startswith("00") else "zero" if digits[0] == "0" else "no prefix")
    if "(" in body and ")" in body:
        out.append("brackets")
    if body.count("(") != body.count(")"):
        out.append("open bracket")
    if re.search(r"[^0-9]{2}", body.replace(") ", " ").replace(" (", " ").replace("+(", "(")):
        out.append("signs in a row")
    if re.search(r"(?<!\d)(?:(?:[0-3]?\d)[./-](?:[01]?\d)[./-](?:19|20)\d\d|(?:19|20)\d\d[./-][01]?\d[./-][0-3]?\d|(?:19|20)\d\d-(?:19|20)\d\d)(?!\d)", body):
        out.append("date")
    if body.startswith(("978", "979")):
        out.append("book")
    if 12 <= n <= 19:
        out.append("check digit" if luhn(digits) else "no check digit")
    if all(len(g) == 4 for g in groups[:-1]) and len(groups) > 2:
        out.append("fours")
    return [f"{kind} {f}" for f in out]


class Zone:
    """Tokens of a zone, and its candidate segments: (first token, token behind the last, kind, features)."""

    def __init__(self, text: str, start: int, end: int):
        self.cuts = [start] + [m.end() for m in _TOKEN.finditer(text, start, end)]
        self.segments: list[tuple[int, int, int, list[str]]] = []
        n = len(self.cuts) - 1
        for i in range(n):
            low = self.cuts[i]
            first = text[low]
            if not (first.isalnum() or first in "+(:_") or (low and first.isalnum() and text[low - 1].isalnum()):
                continue
            digits, letters = 0, False
            for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
                high = self.cuts[j]
                digits += (high - self.cuts[j - 1]) * text[high - 1].isdecimal()
                letters = letters or text[high - 1].isalpha() or text[high - 1] in "@:"
                if digits > _MOST_DIGITS and not letters:
                    break
                last = text[high - 1]
                if not (last.isalnum() or last == ":") or (high < len(text) and text[high].isalnum()):
                    continue
                for kind in _kinds(text[low:high]):
                    self.segments.append((i, j, KINDS.index(kind) + 1, features(text, low, high, kind)))


STATES = len(KINDS) + 1  # 0: outside


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


class Field:
    """Weights of features and of neighbouring labels."""

    def __init__(self, weights: dict[str, float], turns: np.ndarray):
        self.weights, self.turns = weights, turns.tolist()

    def decode(self, zone: Zone) -> list[tuple[int, int, int]]:
        """The segments of the best division."""
        if not zone.segments:
            return []
        n, turns = len(zone.cuts) - 1, self.turns
        best = [[-math.inf] * STATES for _ in range(n + 1)]
        back: list[list] = [[None] * STATES for _ in range(n + 1)]
        best[0][0] = 0.0
        ending: list[list] = [[] for _ in range(n + 1)]
        for i, j, kind, own in zone.segments:
            ending[j].append((i, kind, sum(self.weights.get(f, 0.0) for f in own)))
        for j in range(1, n + 1):
            for i, kind, score in [(j - 1, 0, 0.0), *ending[j]]:
                before = best[i]
                s = max(range(STATES), key=lambda s: before[s] + turns[s][kind])
                value = before[s] + turns[s][kind] + score
                if value > best[j][kind]:
                    best[j][kind], back[j][kind] = value, (i, s)
        found, j, kind = [], n, max(range(STATES), key=lambda s: best[n][s])
        while j > 0:
            i, before = back[j][kind]
            if kind:
                found.append((zone.cuts[i], zone.cuts[j], kind))
            j, kind = i, before
        return found[::-1]

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans, and all, by kind and start."""
        base = base_spans(text)
        added = [(KINDS[k - 1], s, e) for z in _between(zones(text), base) for s, e, k in self.decode(Zone(text, *z))]
        return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def fit(texts: list[tuple[str, list[tuple[str, int, int]]]], passes: int = PASSES) -> Field:
    """The weights under which the labelled divisions are most probable, with a pull to 0."""
    examples, names = [], {}
    for text, spans in texts:
        gold = {(s, e): KINDS.index(k) + 1 for k, s, e in spans}
        for start, end in _between(zones(text), base_spans(text)):
            zone = Zone(text, start, end)
            if zone.segments:
                own = [(i, j, k, [names.setdefault(f, len(names)) for f in fs]) for i, j, k, fs in zone.segments]
                right = {(i, j, k) for i, j, k, _ in own if gold.get((zone.cuts[i], zone.cuts[j])) == k}
                examples.append((len(zone.cuts) - 1, own, right))
    weights, turns = np.zeros(len(names)), np.zeros((STATES, STATES))
    moments = [np.zeros_like(x) for x in (weights, turns, weights, turns)]
    for step in range(1, passes + 1):
        grads = _gradients(examples, weights, turns)
        for n, (x, grad) in enumerate(zip((weights, turns), grads)):
            grad = grad - 0.05 * x
            m, v = moments[n], moments[n + 2]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            x += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        turns[0, 0] = 0
    return Field({f: float(weights[i]) for f, i in names.items()}, turns)


def _gradients(examples: list, weights: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log probability of the right divisions: what they hold less what is expected of all."""
    by_weight, by_turn, t = np.zeros_like(weights), np.zeros_like(turns), turns.tolist()
    w = weights.tolist()
    for n, segments, right in examples:
        steps = [(j - 1, j, 0, 0.0, None) for j in range(1, n + 1)] + [(i, j, k, sum(w[f] for f in fs), fs) for i, j, k, fs in segments]
        steps.sort(key=lambda x: x[1])
        ahead = [[-math.inf] * STATES for _ in range(n + 1)]
        ahead[0][0] = 0.0
        into: list[list] = [[[] for _ in range(STATES)] for _ in range(n + 1)]
        for at, group in _grouped(steps, 1):
            for i, _, k, score, _ in group:
                into[at][k].append(_sum([ahead[i][s] + t[s][k] for s in range(STATES)]) + score)
            for k in range(STATES):
                if into[at][k]:
                    ahead[at][k] = _sum(into[at][k])
        behind = [[-math.inf] * STATES for _ in range(n + 1)]
        behind[n] = [0.0] * STATES
        steps.sort(key=lambda x: -x[0])
        for at, group in _grouped(steps, 0):
            for s in range(STATES):
                behind[at][s] = _sum([t[s][k] + score + behind[j][k] for _, j, k, score, _ in group])
        total = _sum(ahead[n])
        for i, j, k, score, fs in steps:
            share = 0.0
            for s in range(STATES):
                p = math.exp(min(0.0, ahead[i][s] + t[s][k] + score + behind[j][k] - total)) if ahead[i][s] > -math.inf else 0.0
                by_turn[s, k] -= p
                share += p
            if fs is not None:
                by_weight[fs] += ((i, j, k) in right) - share
        at, state, starts = 0, 0, {i: (j, k) for i, j, k in right}
        while at < n:
            at, k = starts.get(at, (at + 1, 0))
            by_turn[state, k] += 1
            state = k
    return by_weight, by_turn


def _grouped(steps: list, by: int) -> Iterator[tuple[int, list]]:
    group: list = []
    for x in steps:
        if group and group[-1][by] != x[by]:
            yield group[-1][by], group
            group = []
        group.append(x)
    if group:
        yield group[-1][by], group


# --- a stated set of labelled texts -----------------------------------------------------------------

_FILL = "the of and to in is was for on with by from this that we they have been les des une dans pour avec sur est der die und von mit auf ist nicht los las una para con por es son".split()


def _card(r: random.Random, n: int) -> str:
    digits = r.choice("3456") + "".join(r.choice("0123456789") for _ in range(n - 2))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _cut(text: str, sizes: list[int], sign: str) -> str:
    parts, at = [], 0
    for size in sizes:
        parts.append(text[at:at + size])
        at += size
    return sign.join(p for p in parts if p)


def _word(r: random.Random) -> str:
    return "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3)))


def _value(r: random.Random) -> tuple[str | None, str, str]:
    """(kind or None, what names it, value) of a usual form."""
    names = {k: v.split() for k, v in NAMED.items()}
    sign = r.choice(" -.")
    made = r.randrange(24)
    if made < 5:
        area = r.choice(["0", ""]) + _digits(r, r.choice([2, 3]))
        body = r.choice([
            f"({area}) {_cut(_digits(r, 7), [3, 4], r.choice(' -'))}", f"{area}{sign}{_cut(_digits(r, 7), [3, 4], sign)}", f"00{r.randint(20, 99)} {_digits(r, 2)} {_cut(_digits(r, 8), [4, 4], ' ')}",
            _cut("0" + _digits(r, 9), [2] * 5, r.choice(" .")), f"0{_digits(r, 3)}/{_digits(r, r.randint(6, 8))}", f"0{_digits(r, 3)} {_digits(r, 6)}",
        ])
        return "phone", r.choice([*names["phone"], ""]), body
    if made < 7:
        return "phone", r.choice(names["phone"]), r.choice(["0", "1", "7"]) + _digits(r, r.randint(8, 10))
    if made < 10:
        form = r.randrange(4)
        body = _cut(_card(r, 15), [4, 6, 5], r.choice(" -.")) if form == 0 else _cut(_card(r, 16), [4] * 4, r.choice([".", "\xa0", "/", "  "])) if form < 3 else _card(r, 15)
        return "card", r.choice([*names["card"], ""] if form else names["card"]), body
    if made < 13:
        at, dot = r.choice([(" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", "."), ("[at]", "[dot]"), (" AT ", " DOT ")])
        host = r.choice([_word(r), f"{_word(r)}{dot}{_word(r)}", f"{_word(r)}-{_word(r)}"])
        return "email", r.choice([*names["email"], ""]), f"{r.choice([_word(r), _word(r) + '.' + _word(r), _word(r) + _digits(r, 2)])}{at}{host}{dot}{r.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io', 'info'])}"
    if made < 15:
        parts = [f"{r.randrange(65536):x}" for _ in range(8)]
        body = ":".join(parts) if r.random() < 0.6 else "::".join((":".join(parts[:r.randint(1, 3)]), ":".join(parts[-r.randint(1, 3):])))
        return "ip", r.choice([*names["ip"], ""]), body
    harmless = r.choice([
        f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.{r.randint(1950, 2030)}", f"{r.randint(1950, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1900, 2000)}-{r.randint(2001, 2030)}",
        f"978-{_cut(_digits(r, 10), [1, 4, 4, 1], '-')}", f"{r.randint(1, 999)},{_digits(r, 3)},{_digits(r, 3)}.00", _digits(r, r.randint(7, 12)), _digits(r, r.randint(13, 19)), _digits(r, 16), _cut(_digits(r, 16), [4] * 4, r.choice(" -.")),
        f"{_digits(r, 2)}:{_digits(r, 2)}:{_digits(r, 2)}", f"{r.randint(0, 9)}.{_digits(r, r.randint(7, 12))}", f"{_digits(r, 5)}-{_digits(r, 5)}-{_digits(r, 5)}", f"{_digits(r, 2)}/{_digits(r, 6)}",
        f"{_word(r)} at {_word(r)} point {_word(r)}", f"{r.randint(1950, 2030)}/{_digits(r, 2)}/{_digits(r, 2)} {_digits(r, 2)}:{_digits(r, 2)}", " ".join(_digits(r, 1) for _ in range(r.randint(7, 14))), " ".join(_digits(r, r.randint(1, 4)) for _ in range(r.randint(4, 8))),
    ])
    if luhn(_NOT_DIGITS.sub("", harmless) or "1") and 15 <= len(_NOT_DIGITS.sub("", harmless)) <= 19:
        harmless = _digits(r, 8)
    return None, r.choice([*names["harmless"], "", "", "", ""]), harmless


def example(seed: int) -> tuple[str, list[tuple[str, int, int]]]:
    """A labelled text: words, and some values of usual forms among them."""
    r = random.Random(seed)
    text, spans = "", []
    for _ in range(r.randint(1, 4)):
        text += " ".join(r.choice([r.choice(_FILL), _word(r)]) for _ in range(r.randint(2, 7))) + r.choice([" ", ", ", ". ", ": ", "\n", " | "])
        kind, name, body = _value(r)
        if name:
            text += r.choice([name, name.capitalize(), name.upper()]) + r.choice([" ", ": ", ". ", " = ", " is "])
        if kind:
            spans.append((kind, len(text), len(text) + len(body)))
        text += body + r.choice([" ", ", ", ". ", "\n", " | ", "; "])
    return text, spans


def findings(spark: SparkSession, n: int = MAX_ROWS, first: int = 0) -> DataFrame:
    """(text, spans): n labelled texts of usual forms in four languages' words, the same at every call."""
    importable()

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [example(int(i)) for i in batch["id"]]
            yield pd.DataFrame({"text": [t for t, _ in rows], "spans": [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for _, spans in rows]})

    return spark.range(first, first + n).mapInPandas(made, f"text string, spans {SPANS}")


def train(labelled: DataFrame, max_rows: int = MAX_ROWS, passes: int = PASSES) -> Field:
    """A field from labelled texts (text, spans), at most ``max_rows`` of them, picked by hash."""
    importable()
    rows = labelled.where("text is not null").select("text", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
    chosen = rows.orderBy(F.xxhash64("text"), "text").limit(max_rows).coalesce(1)

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [(t, [(s["kind"], s["start"], s["end"]) for s in spans]) for b in batches for t, spans in zip(b["text"], b["spans"])]
        yield pd.DataFrame({"field": [pickle.dumps(fit(texts, passes))]})

    return pickle.loads(chosen.mapInPandas(learned, "field binary").collect()[0]["field"])  # one row of weights


def scan(docs: DataFrame, field: Field, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """All columns, the base spans, and all spans, each by kind and start. One narrow stage."""
    importable()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @pandas_udf(f"base {SPANS}, spans {SPANS}")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            both = [own.spans(t or "") for t in texts]
            yield pd.DataFrame({name: [[{"kind": k, "start": s, "end": e} for k, s, e in x[i]] for x in both] for i, name in enumerate(("base", "spans"))})

    rows = without(docs, {base, spans} - {text})
    both = rows.withColumn("_found", found(F.col(text)))
    return both.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("_found.base").alias(base), F.col("_found.spans").alias(spans))
