"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The patterns (email, ip, card, phone) are searched so that each costs time in proportion to the text, also on
long runs of digits or letters.

The field tags blank-separated tokens as outside, or as beginning or inside of a kind. Its features are word
shapes: the token's shape (runs of letters and digits with their lengths), its neighbours' shapes, its cue
words, and whether a digit, ``@`` or ``+`` is in it. It is trained from ``LABELLED``, a small table, by gradient
ascent on the exact log-likelihood (forward and backward sums), and decoded by Viterbi for many windows at a
time. A window is a run of tokens with a digit, ``@``, ``+`` or a spelt-out sign, with ``AROUND`` tokens on both sides;
beyond them there is no token that the field could begin a kind with.

A span of the field is added where it overlaps no span of the patterns of any kind; none of theirs is changed.

Defined results: null and empty texts have no spans; positions are code points, the end exclusive; repeated
rows have equal results; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import shared, small_batches, table

KINDS = ("email", "ip", "card", "phone")
AROUND = 5

Span = tuple[int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# possessive, and only from the first digit of a run: no run is read twice
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Each ``@`` with the longest local part before it that no earlier match has taken."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def _small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    out = []
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(m.span())
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    digit = _DIGIT.search(text)
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if digit else [],
        "card": cards(text) if digit else [],
        "phone": phones(text) if digit and "+" in text else [],
    }


# ---- the field -----------------------------------------------------------------------------------

#: The labelled table. A span is marked [kind ...].
LABELLED = (
    "please call [phone (555) 123-4567] before noon",
    "call [phone 555-123-4567] or write to us",
    "my number is [phone 555 123 4567] now",
    "phone: [phone 030/1234567] in the office",
    "tel. [phone 0151 23456789] after six",
    "reach me on [phone 555.123.4567] today",
    "fax [phone (212) 555-0199] for orders",
    "mobile [phone 07700 900123] at home",
    "phone [phone +49 (30) 1234-567] is the new one",
    "call us at [phone +1 (224) 555-1234] any time",
    "and so [phone +1 (988) 555-2485] it went",
    "on that [phone (988) 555-2485] it went",
    "the old [phone 988-555-2485] the new",
    "she wrote [email ann at example dot com] yesterday",
    "mail [email john dot smith at mail dot example dot org] please",
    "ask [email tom at host dot net] today",
    "message [email eva at school dot edu] now",
    "write to [email jim at office dot com] about it",
    "reach [email pat at club dot org] later",
    "or at [email kim at lab dot example dot net] in may",
    "contact [email bob [at] example [dot] com] for more",
    "write to [email carol (at) example (dot) net] soon",
    "to [email dave@localhost] the message went",
    "sent by [email eve.1@mail3.example.com] again",
    "from [email f_g@example.org] we heard",
    "of the [email rhokk.73@mail2.example.com] it is",
    "server [ip 10.0.0.1] is down",
    "at [ip 192.168.1.20] it stopped",
    "host [ip 10 . 0 . 0 . 1] answers",
    "address [ip 172.16.254.3:8080] was open",
    "the [ip 42.144.35.254] and the rest",
    "card [card 4111 1111 1111 1111] was charged",
    "pay with [card 4111-1111-1111-1111] only",
    "card number [card 4041894974608795] is lost",
    "the [card 4337166598464399] was here",
    "of the [card 4111.1111.1111.1111] she said",
    "two cards [card 4337166598464399] [card 4041894974608795] were lost",
    "a call from [phone +1 (826) 555-4081] [ip 190.137.223.204] came in",
    "the [phone +1 (644) 555-7859] [card 4876179267539117] of it",
    "on [ip 42.144.35.254] [card 4944339490429605] it was",
    "in 1997 the house was sold for 2000 coins",
    "version 2.0 of the license is of 2004",
    "licensed under the apache license, version 2.0. the rest",
    "public license, version 3. this work",
    "on 2023-11-05 at 10:30 we met",
    "the 12 of may 1999 was a monday",
    "page 12 of 40 and line 7",
    "see section 4.2.1 for the rule",
    "item 42, box 7, row 19",
    "it cost 1,234.50 in all",
    "about 3.14 or 22/7 of it",
    "between 10 and 20 of them at noon",
    "order 20231105 was sent",
    "room 101 at the top",
    "token = 0b96a8c8d79c4a5085c919698889f59b72ab7bb6 is here",
    "key 9233a8ecf7c5b09fe594 of it",
    "she looked at the dot on the wall",
    "meet me at ten and at noon",
    "the dot com years are over",
    "meet her at the dot com fair",
    "he looked at a dot on the map",
    "a + b is c and 1 + 2 is 3",
    "isbn 978-3-16-148410-0 is out",
    "from 9.30 to 17.00 each day",
    "he scored 12-4 and 7-5 that day",
    "the year 2020 and 2021 and 2022",
    "no 1 no 2 no 3 no 4 no 5",
    "it weighs 12.5 kg and 100 g",
    "chapter 3 verse 16 line 2",
    "a4 paper and b2 vitamins",
    "the + sign stands at the end",
    "ends with 99% of 1000 rows",
)

_TOKEN = re.compile(r"\S+")
_SIGN = re.compile(r"[0-9@+]")
_SIGN_OR_DOT = re.compile(r"[0-9@+]|(?i:\bdot\b)")
_CUES = frozenset("at dot [at] (at) [dot] (dot) . phone tel tel. phone: call fax mobile number card visa mail ip host server address version".split())
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+|[^\S\n]+|.", re.S)
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def shape(token: str) -> str:
    """Letters as x and digits as d with the length of digit runs up to 20; other signs as they are."""
    if len(token) > 64:
        return "long"
    out = []
    for run in _RUNS.findall(token):
        if run[0].isdigit():
            out.append(f"d{min(len(run), 20)}")
        elif run[0].isalpha():
            out.append("x")
        else:
            out.append(run)
    return "".join(out[:16])


def features(tokens: list[str]) -> list[list[str]]:
    """Word shapes of each token and its neighbours."""
    shapes = ["", "", *map(shape, tokens), "", ""]
    out = []
    for i, token in enumerate(tokens):
        low = token.lower()
        own = [f"s={shapes[i + 2]}", f"p={shapes[i + 1]}|{shapes[i + 2]}", f"n={shapes[i + 2]}|{shapes[i + 3]}"]
        own += [f"pp={shapes[i]}|{shapes[i + 1]}", f"nn={shapes[i + 3]}|{shapes[i + 4]}"]
        digits = sum(c.isdigit() for c in token[:64])
        own.append(f"d={min(digits, 20)}")
        own += [f"has{c}" for c in "@+.-(/[:" if c in token]
        if low in _CUES:
            own.append(f"w={low}")
        if i and tokens[i - 1].lower() in _CUES:
            own.append(f"pw={tokens[i - 1].lower()}")
        if i + 1 < len(tokens) and tokens[i + 1].lower() in _CUES:
            own.append(f"nw={tokens[i + 1].lower()}")
        out.append(own)
    return out


def parse(line: str) -> tuple[list[str], list[int]]:
    """Tokens and labels of a line of ``LABELLED``."""
    tokens, labels, kind, first = [], [], None, False
    for raw in line.split(" "):
        if raw[:1] == "[" and raw[1:] in KINDS:
            kind, first = raw[1:], True
            continue
        ends = kind is not None and raw.endswith("]") and raw not in ("[at]", "[dot]")
        tokens.append(raw[:-1] if ends else raw)
        labels.append(LABELS.index(f"{'B' if first else 'I'}-{kind}") if kind else 0)
        first = False
        if ends:
            kind = None
    return tokens, labels


class Field:
    """Weights of features per label, and of neighbouring labels."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def potentials(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros((len(tokens), len(LABELS)))
        for i, own in enumerate(features(tokens)):
            known = [self.names[f] for f in own if f in self.names]
            if known:
                out[i] = self.emit[known].sum(0)
        return out

    def decode(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each window of potentials; Viterbi over all windows of a batch in step."""
        order = sorted(range(len(windows)), key=lambda i: -len(windows[i]))
        out: list[np.ndarray] = [np.zeros(0, int)] * len(windows)
        at = 0
        while at < len(order):
            # windows of like length, bounded in all
            longest = len(windows[order[at]])
            some = order[at : at + max(1, 200_000 // max(longest, 1))]
            at += len(some)
            lengths = np.array([len(windows[i]) for i in some])
            padded = np.zeros((len(some), longest, len(LABELS)))
            for row, i in enumerate(some):
                padded[row, : lengths[row]] = windows[i]
            best = padded[:, 0] + self.move[-1]
            back = np.zeros((len(some), longest, len(LABELS)), np.int8)
            for t in range(1, longest):
                live = int((lengths > t).sum())
                paths = best[:live, :, None] + self.move[None, :-1]
                back[:live, t] = paths.argmax(1)
                best[:live] = paths.max(1) + padded[:live, t]
            last = best.argmax(1)
            for row, i in enumerate(some):
                path = np.zeros(lengths[row], int)
                label = int(last[row])
                for t in range(lengths[row] - 1, -1, -1):
                    path[t] = label
                    label = int(back[row, t, label])
                out[i] = path
        return out


def _allowed() -> np.ndarray:
    """0, or a prohibition: inside follows beginning or inside of its own kind. The last row is the start."""
    ban = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, to in enumerate(LABELS):
        if to[0] == "I":
            ban[:, j] = -1e6
            for i, of in enumerate(LABELS):
                if of[1:] == to[1:]:
                    ban[i, j] = 0
    return ban


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(lines: tuple[str, ...] = LABELLED, passes: int = 60, rate: float = 0.3, keep: float = 0.02) -> Field:
    """Exact gradient of the log-likelihood over the whole table, AdaGrad, L2."""
    data = [parse(line) for line in lines]
    seen = [features(tokens) for tokens, _ in data]
    names = {f: i for i, f in enumerate(sorted({f for line in seen for own in line for f in own}))}
    rows = [[np.array([names[f] for f in own]) for own in line] for line in seen]
    emit, ban = np.zeros((len(names), len(LABELS))), _allowed()
    move = np.zeros_like(ban)
    past_e, past_m = np.full_like(emit, 0.1), np.full_like(move, 0.1)
    for _ in range(passes):
        g_e, g_m = -keep * emit, -keep * move
        for line, (_, labels) in zip(rows, data, strict=True):
            score = np.array([emit[own].sum(0) for own in line])
            step = move + ban
            ahead = [score[0] + step[-1]]
            for s in score[1:]:
                ahead.append(_log_sum(ahead[-1][:, None] + step[:-1], 0) + s)
            behind = [np.zeros(len(LABELS))]
            for s in score[:0:-1]:
                behind.append(_log_sum(step[:-1] + (s + behind[-1])[None, :], 1))
            behind.reverse()
            whole = _log_sum(ahead[-1], 0)
            for t, own in enumerate(line):
                push = -np.exp(ahead[t] + behind[t] - whole)
                if t == 0:
                    g_m[-1] += push
                    g_m[-1, labels[0]] += 1
                else:
                    g_m[:-1] -= np.exp(ahead[t - 1][:, None] + step[:-1] + (score[t] + behind[t])[None, :] - whole)
                    g_m[labels[t - 1], labels[t]] += 1
                push[labels[t]] += 1
                np.add.at(g_e, own, push)
        past_e += g_e**2
        past_m += g_m**2
        emit += rate * g_e / np.sqrt(past_e)
        move += rate * g_m / np.sqrt(past_m)
    return Field(names, emit, move + ban)


def windows_of(text: str) -> list[list[tuple[str, int, int]]]:
    """Tokens with their places around every sign that a kind could begin with."""
    out: list[list[tuple[str, int, int]]] = []
    reach = -1
    signs = _SIGN_OR_DOT if "dot" in text.lower() else _SIGN
    for sign in signs.finditer(text):
        if sign.start() < reach:
            continue
        # the run: from AROUND tokens before the sign, to AROUND plain tokens after the last token with a sign
        begin = sign.start()
        low = max(reach, 0)
        for back in range(AROUND + 1):
            while begin > low and not text[begin - 1].isspace():
                begin -= 1
            while back < AROUND and begin > low and text[begin - 1].isspace():
                begin -= 1
        run, plain = [], 0
        for m in _TOKEN.finditer(text, begin):
            run.append((m.group(), m.start(), m.end()))
            plain = 0 if m.start() <= sign.start() or signs.search(m.group()) else plain + 1
            if plain >= AROUND:
                break
        if run:
            reach = run[-1][2]
            out.append(run)
    return out


def field_spans(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) that the field finds in each text."""
    owners, runs = [], []
    for i, text in enumerate(texts):
        for run in windows_of(text):
            owners.append(i)
            runs.append(run)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    paths = field.decode([field.potentials([t for t, _, _ in run]) for run in runs])
    for i, run, path in zip(owners, runs, paths, strict=True):
        t = 0
        while t < len(run):
            if LABELS[path[t]][0] != "B":
                t += 1
                continue
            kind, first = LABELS[path[t]][2:], t
            t += 1
            while t < len(run) and LABELS[path[t]] == f"I-{kind}":
                t += 1
            start, end = run[first][1], run[t - 1][2]
            trimmed = texts[i][start:end]
            left = len(trimmed) - len(trimmed.lstrip("\"'<,;:"))
            right = len(trimmed) - len(trimmed.rstrip("\"'>,;:!?."))
            if plausible(kind, trimmed):
                out[i].append((kind, start + left, end - right))
    return out


def plausible(kind: str, found: str) -> bool:
    """What a kind cannot do without: digits in number, a card's check digit, an email's sign or its name."""
    number = _NOT_DIGIT.sub("", found)
    digits = len(number)
    if kind == "email":
        words = found.lower().replace("[", " ").replace("]", " ").replace("(", " ").replace(")", " ").split()
        return "@" in found or ("at" in words and "dot" in words)
    if kind == "card":
        return 13 <= digits <= 19 and luhn(number)
    return 4 <= digits <= 17 if kind == "ip" else 7 <= digits <= 15


def found_in(texts: list[str | None], field: Field) -> pd.DataFrame:
    """base and all spans of each text, as text, with the counts of the base."""
    whole = [t or "" for t in texts]
    base = [base_spans(t) for t in whole]
    more = field_spans(whole, field)
    rows = []
    for own, added in zip(base, more, strict=True):
        every = {k: list(own[k]) for k in KINDS}
        taken = sorted(s for spans in own.values() for s in spans)
        starts = np.array([s for s, _ in taken])
        ends = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else np.array([])
        for kind, start, end in added:
            before = int(np.searchsorted(starts, end, "left"))
            if not before or ends[before - 1] <= start:
                every[kind].append((start, end))
        listed = lambda spans: ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))
        rows.append((*(len(own[k]) for k in KINDS), hashlib.sha256(listed(own).encode()).hexdigest(), listed(every)))
    return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


_FOUND = T.StructType([
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
])


def op1_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    small_batches(spark)
    field = shared(spark, train())

    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        return found_in(texts.tolist(), field())

    return table(spark, sf_dir, "documents").select("doc_id", find("text").alias("found")).select("doc_id", "found.*")
