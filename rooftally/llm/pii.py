"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them.

The field runs over white-space tokens. What it knows of a token is its word shape and the shape and
cue of its neighbours, learned from a small labelled table; texts are decoded by Viterbi over arrays.
Where the scores of a token leave no doubt (no transition could make up for another label), the chain
may be cut without changing the best path, so only the doubtful stretches are decoded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready

# --- Fixed values: kinds and patterns of the base, in order. ---
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --- End of fixed values. ---

ADDED = ("secret", "id")
LABELS = ("none", *KINDS, *ADDED)
_KNOWN = 300_000

# A span is written [kind:text]; everything else is none of them.
TABLE = (
    "write to [email:anna.berg@post.example.org] before noon", "mail [email:k.lund77@web.example] or ask inside", "her address is [email:jo_9@mx2.example.net] now",
    "send it to [email:ria.moss(at)mail(dot)example(dot)com] today", "reach [email:leo[at]corp[dot]example] instead", "contact [email:pat(at)shop.example] for details",
    "the host [ip:10.20.30.40] did not answer", "from ip [ip:192.168.7.21] at night", "server [ip:172.16.254.3] is down", "login from [ip:8.8.4.4] was refused",
    "paid with card [card:4111 1111 1111 1111] in may", "card number [card:5500-0000-0000-0004] was declined", "charge [card:340000000000009] and close", "visa [card:4012888888881881] expires soon",
    "call [phone:+44 20 7946 0958] after six", "her phone is [phone:+1 (212) 555-0142] at work", "tel [phone:+49-30-901820] or fax", "ring [phone:(020) 7946 0018] please", "phone [phone:555-867-5309] works too",
    "mobile [phone:+33 6 12 34 56 78] in the evening", "dial [phone:+1 (415) 555-2671] and wait", "the number +1 is not a phone",
    "the line said [secret:password=9f86d081884c7d6599] in clear", "set [secret:passwd=Tr0ub4dor&3x] and restart", "with [secret:api_key=AKQ3941LLZP0288TX] in it", "found [secret:secret=c0ffee254729296a45] there",
    'saw token = [secret:"2c26b46b68ffc68ff99b453c1d30413413422d70"] in the file', 'use key = [secret:"fcde2b2edba56bf408601fb721fe9b5c338d10ee"] for it', "header token: [secret:eyJ0eXAiOiJKV1Qi9.eyJzdWIi0.3Xq7] was sent",
    "password = [secret:hunter2b7db7aa4a5] was stored", "secret: [secret:486ea46224d1bb4fb680f34f7c9ad96a8f24ec88] leaked", "[secret:token=1b4f0e9851971998e732078544c96b36] in the log",
    "her ssn is [id:078-05-1120] on the form", "ssn [id:219-09-9999] was typed", "iban [id:DE89370400440532013000] for rent", "iban [id:GB29NWBK60161331926819] was used", "passport [id:X4RTBPFW4] expired",
)
# Lines without any: words, junk, tables, prices, dates and versions.
PLAIN = (
    "the quick brown fox jumps over a lazy dog", "In the morning, they went out. Nobody knew why.", "Ou sont les neiges d'antan? Là-bas, peut-être.", "Über allen Gipfeln ist Ruh, in allen Wipfeln",
    "El perro corrió; la niña lloró. Mañana será otro día.", "THIS IS ALL IN CAPITALS AND LOUD", "He said: \"no, never!\" and (then) left...", "one two three four five six seven eight nine ten",
    "released under version 2.0 in 1998", "it cost 1,299.00 dollars on 12 May 2021", "call him in 2 or 3 days, not 10", "room 404 on floor 12", "from 2019-05-04 to 2020-11-30 inclusive", "at 10:45 on 3/4/1999 they met",
    "population 83190556 and 1234567 homes", "chapter 3.2.1 and section 4.5", "v1.2.3 of the tool", "see https://www.example.org/a/b?c=1&d=2 for more", "http://example.com/page.html is gone", "www.example.net lists it",
    "name | price | number | note", "alpha | beta | gamma. | delta |", "word*** other### more$$$ and%%% that&&&", "again,*** then.### here*** of$$$ is&&&", "THE!! END!! IS,!! HERE!!", "%%% *** ### $$$ &&& @@@",
    "a key part of the token economy", "the password was lost and the secret kept", "phone and email are old words", "the card was on the table", "ip law and ssn rules", "tel and iban, id and passport", "x = y + 1 and a = b",
    "let value = 12 and size = 40", "foo_bar and baz_qux(1) return 0;", "for i in range(10): print(i)", "<p>text</p> <br/> {a: 1, b: 2} [1] [2]", "5% of 40% is 2%", "#tag and @name are here", "isbn and issue no. 7, p. 34-35", "temperature -5 to +30 degrees",
    "Licensed under the License, Version 2.0. All rights reserved.", "Licensed under CC BY-NC 4.0.", "Le Le Le Le Le Le Le Le Le", "At At At At At At At At At At At", "at at at at dot dot dot dot from from from", "they met at noon at the dot on the map at night", "a,b,c;d;e f/g h-i j.k", "mid-1990s co-operation, T-shirt, 3rd 21st 100th", "1 2 3 4 5 6 7 8 9 10 11 12", "12.5 13.75 1.0 2.25 100.0",
)
_MARKED = re.compile(r"\[(" + "|".join((*KINDS, *ADDED)) + r"):((?:\[[^\]]*\]|[^\]])*)\]")
_CUES = frozenset((
    "password", "passwd", "pwd", "token", "secret", "key", "api_key", "apikey", "ssn", "iban", "passport", "card", "visa", "charge", "phone", "tel", "call", "dial", "ring", "mobile",
    "fax", "email", "mail", "contact", "ip", "host", "server", "=", "number", "from", "under", "version", "section", "chapter", "page",
))
_EDGE_LEFT, _EDGE_RIGHT = "\"'([{<", "\"')]}>.,;:!?"


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by kind and then start. Code points, the end exclusive."""
    found = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in m.group().split(".")))]
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(char in "0123456789" for char in m.group()) <= 15]
    return found


_RUNS = re.compile(r"(.)\1+", re.S)
_SHAPE = {**{ord(c): "9" for c in "0123456789"}, **{ord(c): "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{ord(c): "a" for c in "abcdefghijklmnopqrstuvwxyz"}}
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")


def shape(token: str) -> str:
    """The token's letters as ``A`` and ``a``, digits as ``9``, runs of one made one; other marks are kept."""
    raw = "".join(c if c < "\x80" else "a" if c.isalpha() else c for c in token.translate(_SHAPE))
    return _RUNS.sub(r"\1", raw)


def _parted(name: str, value: str, most: int) -> tuple[str, ...]:
    """A feature of the first ``most`` characters of ``value``, and one of a checksum of those beyond them, if there are any."""
    rest = value[most:]
    return (f"{name}={value[:most]}", f"{name}+{zlib.crc32(rest.encode('utf-8', 'surrogatepass')) % 64}") if rest else (f"{name}={value}",)


def token_class(token: str) -> tuple[str, ...]:
    """What the field is told of a token. Tokens that agree in it are scored alike."""
    lowered = token.lower()
    bare = lowered.strip("\"'.,;:!?()") or lowered
    cue = lowered if lowered in _CUES else bare if bare in _CUES else ""
    if token.isalpha():
        return ("word", "cue=" + cue)
    outline = shape(token)
    digits = sum(c in "0123456789" for c in token)
    letters = sum(c.isalpha() for c in token)
    if not digits and not any(c in "@=[]_" for c in token):
        # Words and marks: which marks hardly matters.
        return ("word" if letters else "marks", "cue=" + cue, "bracket=" + str("(" in token and letters > 0))
    amount = next(name for name, most in (("0", 0), ("1", 1), ("2", 2), ("3", 3), ("4", 4), ("6", 6), ("8", 8), ("12", 12), ("19", 19), ("more", 1 << 60)) if digits <= most)
    size = "short" if len(token) < 8 else "middle" if len(token) < 16 else "long"
    mixed = str(bool(letters and digits))
    return (
        *_parted("shape", outline, 24), "digits=" + amount, "size=" + size, f"mixed={mixed},{size}", "cue=" + cue, "hex=" + str(bool(_HEX.search(token))),
        "has=" + "".join(c for c in "@=:/._-()[]+%$," if c in token), *_parted("assign", (re.match(r"(\w+)[=:]\S", lowered) or [""])[0][:-2] if "=" in token or ":" in token else "", 10),
    )


@dataclass
class Field:
    """Weights of the chain: own, preceding and following token's features by label, and transitions."""

    own: dict[str, np.ndarray]
    before: dict[str, np.ndarray]
    after: dict[str, np.ndarray]
    moves: np.ndarray
    classes: dict[tuple[str, ...], int] = field(default_factory=dict)
    known: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)

    def class_of(self, token: str) -> int:
        number = self.known.get(token)
        if number is None:
            features = token_class(token)
            number = self.classes.get(features)
            if number is None:
                number = self.classes[features] = len(self.classes)
                zero = np.zeros(len(LABELS))
                self.rows.append(np.stack([
                    sum((weights.get(name, zero) for name in features), zero) for weights in (self.own, self.before, self.after)
                ]))
            if len(self.known) < _KNOWN:
                self.known[token] = number
        return number

    def emissions(self, tokens: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.class_of, tokens), np.int64, len(tokens))
        unique, inverse = np.unique(numbers, return_inverse=True)
        table = np.stack([self.rows[number] for number in unique])
        scores = table[:, 0][inverse]
        scores[1:] += table[:, 1][inverse[:-1]]
        scores[:-1] += table[:, 2][inverse[1:]]
        return scores

    def doubtful(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that some path of other labels might take; all others are none of the kinds on the best path.

        Making a token of another label none of the kinds costs its neighbours' transitions at most so much.
        """
        moves = self.moves
        cost = (moves - moves[:, :1]).max(axis=0) + (moves - moves[:1]).max(axis=1)
        return (scores[:, :1] - scores[:, 1:] <= cost[1:]).any(axis=1)


def viterbi(runs: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """The best labels of each run of emissions, between tokens that are ``none`` on either side. All runs step together."""
    if not runs:
        return []
    order = np.argsort([-len(run) for run in runs], kind="stable")
    lengths = np.array([len(runs[k]) for k in order])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = np.concatenate([runs[k] for k in order])
    back = np.zeros(flat.shape, dtype=np.int8)
    best = moves[0][None, :] + flat[starts]
    final = np.zeros_like(best)
    live = len(lengths)
    for step in range(1, lengths[0] + 1):
        going = int(np.searchsorted(-lengths, -step, "left"))
        final[going:live] = best[going:live]
        live = going
        if not live:
            break
        paths = best[:live, :, None] + moves[None]
        at = starts[:live] + step
        back[at] = paths.argmax(axis=1)
        best = paths.max(axis=1) + flat[at]
    labels = np.zeros(len(flat), dtype=np.int8)
    label = (final + moves[:, 0][None, :]).argmax(axis=1)
    labels[starts + lengths - 1] = label
    for step in range(lengths[0] - 1, 0, -1):
        going = int(np.searchsorted(-lengths, -step, "left"))
        at = starts[:going] + step
        labels[at - 1] = back[at, labels[at]]
    result = [None] * len(runs)
    for place, k in enumerate(order):
        result[k] = labels[starts[place]:starts[place] + lengths[place]]
    return result


def parse_table(lines: tuple[str, ...]) -> list[tuple[list[str], list[int]]]:
    """Tokens and labels of marked lines."""
    parsed = []
    for line in lines:
        tokens, labels, at = [], [], 0
        for match in _MARKED.finditer(line):
            plain, inside = line[at:match.start()].split(), match.group(2).split()
            tokens += plain + inside
            labels += [0] * len(plain) + [LABELS.index(match.group(1))] * len(inside)
            at = match.end()
        rest = line[at:].split()
        parsed.append((tokens + rest, labels + [0] * len(rest)))
    return parsed


@lru_cache(maxsize=2)
def train(table: tuple[str, ...] = TABLE + PLAIN, steps: int = 400, decay: float = 0.0005) -> Field:
    """A field fitted to the marked lines by gradient ascent on their likelihood, with all sequences in one array."""
    rows = parse_table(table)
    # Each line also between others, so that the middle of a text is learned as well as its edges.
    ids: dict[tuple[int, str], int] = {}
    longest, count, labels_n = max(len(tokens) for tokens, _ in rows), len(rows), len(LABELS)
    cells, columns = [], []
    gold = np.zeros((count, longest), dtype=np.int64)
    mask = np.zeros((count, longest), dtype=bool)
    for row, (tokens, labels) in enumerate(rows):
        features = [token_class(token) for token in tokens]
        gold[row, :len(labels)], mask[row, :len(labels)] = labels, True
        for at in range(len(tokens)):
            for kind, place in ((0, at), (1, at - 1), (2, at + 1)):
                if 0 <= place < len(tokens):
                    for name in features[place]:
                        cells.append(row * longest + at)
                        columns.append(ids.setdefault((kind, name), len(ids)))
    cells, columns = np.array(cells), np.array(columns)
    weights, moves = np.zeros((len(ids), labels_n)), np.zeros((labels_n, labels_n))
    total_w, total_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    lengths = mask.sum(axis=1)
    one = np.eye(labels_n)
    true_cells = one[gold] * mask[:, :, None]
    padded = np.concatenate([np.zeros((count, 1), np.int64), gold, np.zeros((count, 1), np.int64)], axis=1)
    true_moves = np.zeros_like(moves)
    for row in range(count):
        np.add.at(true_moves, (padded[row, :lengths[row] + 1], padded[row, 1:lengths[row] + 2]), 1)

    def lse(values: np.ndarray, axis: int) -> np.ndarray:
        top = values.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(steps):
        scores = np.zeros((count * longest, labels_n))
        np.add.at(scores, cells, weights[columns])
        scores = scores.reshape(count, longest, labels_n)
        ahead = np.zeros_like(scores)
        ahead[:, 0] = moves[0] + scores[:, 0]
        for at in range(1, longest):
            following = lse(ahead[:, at - 1, :, None] + moves, 1) + scores[:, at]
            ahead[:, at] = np.where(mask[:, at, None], following, ahead[:, at - 1])
        whole = lse(ahead[:, -1] + moves[:, 0], 1)
        behind = np.zeros_like(scores)
        behind[:, -1] = moves[:, 0]
        expected = np.zeros_like(moves)
        for at in range(longest - 1, 0, -1):
            inner = moves + (scores[:, at] + behind[:, at])[:, None, :]
            behind[:, at - 1] = np.where(mask[:, at, None], lse(inner, 2), behind[:, at])
            chance = np.exp(ahead[:, at - 1, :, None] + inner - whole[:, None, None])
            expected += (chance * mask[:, at, None, None]).sum(axis=0)
        marginal = np.exp(ahead + behind - whole[:, None, None]) * mask[:, :, None]
        expected[0] += marginal[:, 0].sum(axis=0)
        expected[:, 0] += marginal[np.arange(count), lengths - 1].sum(axis=0)
        gap = (true_cells - marginal).reshape(-1, labels_n)
        gradient = np.zeros_like(weights)
        np.add.at(gradient, columns, gap[cells])
        gradient -= decay * weights
        by_move = true_moves - expected - 0.2 * moves
        total_w += gradient ** 2
        total_m += by_move ** 2
        weights += 0.5 * gradient / np.sqrt(total_w)
        moves += 0.1 * by_move / np.sqrt(total_m)
    parts: tuple[dict, dict, dict] = ({}, {}, {})
    for (kind, name), at in ids.items():
        parts[kind][name] = weights[at]
    return Field(*parts, moves)


def spans_of(field_: Field, texts: list[str | None]) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """For each text its base spans and the spans that the field adds, which overlap no base span."""
    base, tokens_of, runs, places = [], [], [], []
    for row, text in enumerate(texts):
        text = text or ""
        base.append(base_spans(text))
        tokens = text.split()
        tokens_of.append(len(tokens))
        if not tokens:
            continue
        scores = field_.emissions(tokens)
        doubt = field_.doubtful(scores)
        if doubt.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], doubt, [False]])))
            for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
                runs.append(scores[start:stop])
                places.append((row, start))
    marked: dict[int, list[tuple[int, int, int]]] = {}
    for (row, start), labels in zip(places, viterbi(runs, field_.moves)):
        if labels.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[-1], labels, [-1]])))
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if labels[a]:
                    marked.setdefault(row, []).append((start + a, start + b, int(labels[a])))
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for row, found in marked.items():
        text = texts[row]
        bounds = [match.span() for match in re.finditer(r"\S+", text)]
        taken = sorted((start, stop) for _, start, stop in base[row])
        for first, last, label in sorted(found):
            start, stop = bounds[first][0], bounds[last - 1][1]
            while start < stop and text[start] in _EDGE_LEFT:
                start += 1
            while stop > start and text[stop - 1] in _EDGE_RIGHT:
                stop -= 1
            if start < stop and not any(a < stop and start < b for a, b in taken):
                added[row].append((LABELS[label], start, stop))
    order = {name: place for place, name in enumerate(LABELS)}
    return [(own, sorted(extra, key=lambda span: (order[span[0]], span[1]))) for own, extra in zip(base, added)]


def find(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: id, ``base`` and ``added``, arrays of (kind, start, stop).

    Starts and stops are code points, the stop exclusive. ``base`` has the matches of the fixed patterns that
    pass their checks, leftmost and without overlap within a kind, by kind and start. ``added`` has the field's spans that
    overlap none of them. Null and empty texts have neither; rows that repeat give equal rows, and an empty table
    none. Very long texts are searched whole. Other columns are ignored, whatever their names.
    """
    model = train()
    own, before, after, moves = model.own, model.before, model.after, model.moves
    rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = Field(own, before, after, moves)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = spans_of(field_, batch.column(1).to_pylist())
                sides = [[[{"kind": k, "start": a, "stop": b} for k, a, b in pair[side]] for pair in found] for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(side, span) for side in sides]], ["_id", "base", "added"])

    ready(documents.sparkSession)
    kind = "array<struct<kind:string,start:bigint,stop:bigint>>"
    schema = rows.selectExpr("_id", f"cast(array() as {kind}) base", f"cast(array() as {kind}) added").schema
    return rows.mapInArrow(mark, schema).withColumnRenamed("_id", id_column)
