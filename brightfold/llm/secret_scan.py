"""Secret scans by assignment-aware lexing.

Each text is read on its own, whole, inside its task. Three fixed patterns give the base
spans. Beside them, source and configuration syntax is lexed into name-literal pairs:
assignments (`a = b = "x"`, `x: str = "y"`, `"k": "v"`, `k => 'v'`, `o["k"] = v`), flags
(`--k v`), key and value attributes or lines, elements (`<k>v</k>`) and setters. A value is
a chain of literals, names, calls and brackets, so wrapped, listed and concatenated
literals are found too.

Constants. Each assignment is a node that points to its literals and, for every name in
its value, to that name's assignment last before it (or the first one after it). A target's
score flows down these edges, so a literal is scored by the most sensitive name it ever
reaches, through any number of steps. Scores take few values and only grow, which bounds
the work by the edges.

Scores. A name's words give 0 to 1 (`db_password`, `apiKey`; `password_hint` little); the
assigned characters give 0 to 1 by length and kinds; placeholders give 0. A literal whose
product reaches THRESHOLD becomes a span of kind "named", unless a base span holds it.

Odd input. Null and empty texts have no spans; null ids and repeated rows give a row each;
an empty table gives none. Other columns are not read. Work is linear in the text. A text
without any sensitive word isn't lexed, since no target could score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ["assign", "access", "hex", "named"]
THRESHOLD = 0.5

# The base patterns, and what a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_CHARACTERS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
HEX = re.compile(r"[0-9a-f]{24,}+")

#: How sensitive a word of a name is.
WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "pw": 0.9, "pass": 0.9,
    "secret": 1.0, "secrets": 1.0, "credential": 1.0, "credentials": 1.0, "cred": 0.9, "creds": 0.9,
    "token": 0.9, "tokens": 0.9, "bearer": 0.9, "apikey": 1.0, "authkey": 1.0, "accesskey": 1.0, "secretkey": 1.0,
    "privatekey": 1.0, "authtoken": 1.0, "accesstoken": 1.0, "dbpass": 1.0, "userpass": 1.0, "dbpassword": 1.0,
    "auth": 0.6, "authorization": 0.7, "jwt": 0.7, "salt": 0.6, "dsn": 0.6, "signature": 0.6, "webhook": 0.6, "key": 0.4, "keys": 0.4,
}
#: Words that make a key a secret one.
KEY_OF = {"api", "access", "secret", "private", "auth", "encryption", "encrypt", "signing", "master", "shared", "service", "account",
          "ssh", "aws", "hmac", "jwt", "session", "storage", "deploy", "client", "license", "root", "admin"}
#: Words that say a name holds something about a secret, first or last in it.
ABOUT = {"name", "id", "ids", "file", "path", "dir", "url", "uri", "field", "length", "len", "size", "count", "type", "label", "hint",
         "policy", "prompt", "min", "max", "limit", "ttl", "expiry", "expires", "param", "column", "header", "regex", "pattern", "format",
         "env", "reset", "page", "text", "message", "error", "index", "usage", "num", "n", "has", "is", "use", "show", "forgot", "change", "public"}
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Lower-case pieces without one of which no name can score, and no assignment of the base can match.
STEMS = [w for w in WORDS if not any(v in w for v in WORDS if v != w)]
ASSIGN_STEMS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

PLACEHOLDER = re.compile(
    r"x+|\*+|\.+|-+|#+|0+|<[^>]*>|\[[^\]]*\]|\$?\{.*\}|%.*%|\$\w+|%\(\w+\)s|(?:your|change|example|sample|dummy|placeholder|insert|todo|enter)\b.*"
    r"|change_?me.*|your_.*|none|null|nil|true|false|undefined|redacted|required|optional|string|hidden|masked|n/?a", re.IGNORECASE)
INTERPOLATED = re.compile(r"\$\{?([A-Za-z_]\w*)|\{([A-Za-z_]\w*)\}")
PLACE = re.compile(r"(?:~|\.{0,2})/[\w.\-]+(?:/|$)|[A-Za-z][\w+.\-]*://[^@\s]*$|[A-Z]:\\")

SITE = re.compile(
    r"""(?<![\w$.\-])(?P<flag>--)?(?P<quote>["'`])?(?P<name>[A-Za-z_$][\w$.\-]*+)(?(quote)(?P=quote))\]?[ \t]*+"""
    r"""(?:(?P<op>:=|=>|[+?|]?=(?![=>~])|:(?![:/=]))|(?P<call>\()(?=["'`])|(?(flag)(?P<gap>)(?<=[ \t])|(?!)))"""
)
ELEMENT = re.compile(r"<([A-Za-z_][\w.:\-]*+)[^<>]*+>([^<>\n]++)</\1>")
LINE_START = re.compile(r"""[ \t]*+(?:[#;*\-]+|//)?[ \t]*+(?:(?:export|set|setx|env|ENV|ARG|let|const|var|val|final|static|public|private|String|string|auto)[ \t]++)*+["'`]?$""")
SPACE, SPACE_AND_LINES = re.compile(r"[ \t]*+"), re.compile(r"\s*+")
TERM = re.compile(
    r"""(?P<prefix>[rRbBuUfF@$]{0,2})(?P<delimiter>\"{3}|'{3}|["'`])"""
    r"""|\$\{(?P<braced>[A-Za-z_]\w*)[^}\n]*\}"""
    r"""|(?P<ref>[A-Za-z_$*&][\w$.\-]*+(?![^\s"'`,;()\[\]{}<>+:=?|&]))"""
    r"""|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<between>,|\|\||\?\?|[+.&?:=]|[ \t]+)"""
    r"""|(?P<bare>[^\s"'`,;()\[\]{}<>]++)"""
)
BODY = {
    '"': re.compile(r'(?:[^"\\\n]|\\.)*+(?=")'), "'": re.compile(r"(?:[^'\\\n]|\\.)*+(?=')"), "`": re.compile(r"(?:[^`\\]|\\.)*+(?=`)", re.DOTALL),
    '"""': re.compile(r'(?:[^"\\]|\\.|"(?!""))*+(?=""")', re.DOTALL), "'''": re.compile(r"(?:[^'\\]|\\.|'(?!''))*+(?=''')", re.DOTALL),
}
JOINTS = {"or", "and", "if", "else", "in", "not", "as", "then", "new", "await"}
NAME_LIKE = re.compile(r"[A-Za-z_$*&][\w$.\-]*")
ANCHOR = re.compile(r"&(\w+)[ \t]+")
NESTED = re.compile(r"[ \t]*+(?::=|=>|=(?![=>~])|:(?![:/=]))")
SETTER = re.compile(r"(?:\w+\.)*set")
DIGITS = re.compile(r"\d")
QUERY = re.compile(r"[?&;]([A-Za-z_][\w.\-]*+)=([^&;\s#\"'`]++)")
BARE = re.compile(r"""[^\s"'`,;()\[\]{}<>]++""")
CHAINED = re.compile(r"[ \t]*+=(?![=>~])")
GETTERS = ("get", "getenv", "env", "environ", "getproperty", "getstring", "lookup", "fetch")
KEY_NAMES, VALUE_NAMES = {"key", "name", "id", "property", "param"}, {"value", "content", "default", "defaultvalue"}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, code points, in order of start and then of kind."""
    spans, lower = [], text.lower()
    if any(stem in lower for stem in ASSIGN_STEMS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARACTERS]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def name_score(name: str) -> float:
    """How much a target's name says that a secret is assigned, 0 to 1; the last part of a dotted name counts."""
    words = [w.lower() for w in WORD.findall(name.rsplit(".", 1)[-1])]
    score = max((WORDS.get(w, 0.0) for w in words), default=0.0)
    if score and KEY_OF.intersection(words) and {"key", "keys"}.intersection(words):
        score = max(score, 0.9)
    return score * 0.2 if words and (words[-1] in ABOUT or words[0] in ABOUT) else score


@dataclass
class Make:
    """Characters of a value: how many, and which kinds it has."""

    length: int = 0
    kinds: int = 0
    weak: bool = False

    def add(self, other: Make) -> None:
        self.length += other.length
        self.kinds |= other.kinds
        self.weak |= other.weak

    def quality(self) -> float:
        if self.length < ASSIGN_CHARACTERS:
            return 0.0
        quality = min(1.0, 0.2 + 0.2 * (self.kinds & 15).bit_count() + 0.2 * (self.length >= 16))
        return quality * 0.3 if self.weak or self.kinds & 16 else quality


LOWER, UPPER, DIGIT, OTHER, BLANK = 1, 2, 4, 8, 16
KIND_PATTERNS = [(LOWER, re.compile(r"[a-z]")), (UPPER, re.compile(r"[A-Z]")), (DIGIT, re.compile(r"[0-9]")),
                 (OTHER, re.compile(r"[^\sa-zA-Z0-9]")), (BLANK, re.compile(r"\s"))]


def make_of(literal: str) -> Make:
    if PLACEHOLDER.fullmatch(literal):
        return Make()
    kinds = sum(bit for bit, pattern in KIND_PATTERNS if pattern.search(literal))
    if literal.startswith("-----BEGIN"):
        kinds &= ~BLANK
    return Make(len(literal), kinds, bool(PLACE.match(literal)))


@dataclass
class Pair:
    """An assignment: its targets' score, literals (numbers), earlier assignments it uses, and its characters."""

    targets: list[str]
    literals: list[int] = field(default_factory=list)
    uses: list[int] = field(default_factory=list)
    unknown: list[str] = field(default_factory=list)
    make: Make = field(default_factory=Make)


class Lexer:
    """Name-literal pairs of one text, and how constants flow between them."""

    def __init__(self, text: str):
        self.text = text
        self.literals: list[tuple[int, int]] = []
        self.pairs: list[Pair] = []
        self.known: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.unclosed: set[str] = set()
        self.key: tuple[str, int] | None = None

    def read(self) -> None:
        at, line, seen, text = 0, 0, 0, self.text
        while m := SITE.search(text, at):
            name, pair, at = m["name"], Pair([m["name"]]), m.end()
            # Start of the site's line; every character is looked at once for all sites together.
            line, seen = max(line, text.rfind("\n", seen, m.start()) + 1), m.start()
            if m["call"] and not SETTER.match(name):
                continue
            tight = m["op"] and m["op"] != ":" and not text[m.start("op") - 1].isspace() and not text[at : at + 1].isspace()
            at = max(at, self._value(pair, at, bool(tight or m["flag"] or LINE_START.match(text, line, m.start()))))
            self._attributes(name, pair, m.start(), at)
            self._store(pair)
        if "<" in text:
            for m in ELEMENT.finditer(text):
                pair = Pair([m[1].rsplit(":", 1)[-1]])
                self._literal(pair, *m.span(2))
                self._store(pair)

    def _attributes(self, name: str, pair: Pair, start: int, end: int) -> None:
        """`key="password" value="x"`, on one line or two: the value belongs to the name that the key gives."""
        last = name.rsplit(".", 1)[-1].lower()
        if last in VALUE_NAMES and self.key and self.text.count("\n", self.key[1], start) <= 1:
            pair.targets.append(self.key[0])
        self.key = None
        if last in KEY_NAMES and len(pair.literals) == 1:
            self.key = self.text[slice(*self.literals[pair.literals[0]])], end
        elif last in KEY_NAMES and len(pair.unknown) == 1:
            self.key = pair.unknown[0], end

    def _store(self, pair: Pair) -> None:
        number = len(self.pairs)
        self.pairs.append(pair)
        for target in pair.targets:
            for known in {target, target.rsplit(".", 1)[-1]}:
                self.known[known] = number
                self.first.setdefault(known, number)

    def _literal(self, pair: Pair, start: int, end: int) -> None:
        made = make_of(self.text[start:end])
        if made.length:
            pair.literals.append(len(self.literals))
            self.literals.append((start, end))
            pair.make.add(made)

    def _use(self, pair: Pair, name: str) -> bool:
        name = name.lstrip("$*&")
        found = self.known.get(name, self.known.get(name.rsplit(".", 1)[-1]))
        if found is None:
            pair.unknown.append(name)
            return False
        pair.uses.append(found)
        pair.make.add(self.pairs[found].make)
        return True

    def _interpolated(self, pair: Pair, body: str) -> None:
        for a, b in INTERPOLATED.findall(body):
            self._use(pair, a or b)

    def _string(self, pair: Pair, delimiter: str, at: int, listed: bool) -> int | None:
        """Position past a string whose opening delimiter ends at `at`."""
        if delimiter in self.unclosed:
            return None
        body = BODY[delimiter].match(self.text, at)
        if body is None:
            # No closing mark up to the end: none for any later string of this kind either.
            if delimiter not in ('"', "'"):
                self.unclosed.add(delimiter)
            return None
        if listed:
            self._literal(pair, at, body.end())
            self._interpolated(pair, body[0])
            for m in QUERY.finditer(self.text, at, body.end()):
                inner = Pair([m[1]])
                self._literal(inner, *m.span(2))
                self._interpolated(inner, m[2])
                self._store(inner)
        return body.end() + len(delimiter)

    def _value(self, pair: Pair, at: int, bare: bool) -> int:
        """Read a value into the pair; gives its end. A nested pair's name ends it, so nothing is read twice."""
        text, depth, caller, first, joint = self.text, 0, "", True, True
        at = SPACE.match(text, at).end()
        if bare and (anchor := ANCHOR.match(text, at)):
            pair.targets.append(anchor[1])
            at = anchor.end()
        if bare and (whole := BARE.match(text, at)) and not NAME_LIKE.fullmatch(whole[0]):
            names = re.split(r"[+&]", whole[0])
            if not any(n in self.known for n in names) and not whole[0].startswith("$"):
                self._literal(pair, *whole.span())
                return whole.end()
        while m := TERM.match(text, at):
            kind = m.lastgroup
            if kind == "delimiter":
                past = self._string(pair, m["delimiter"], m.end(), not (depth and caller.lower().endswith(GETTERS)))
                if past is None or (not first and NESTED.match(text, past)):
                    return at if past else m.end()
                caller, at, joint = "", past, False
            elif kind == "between":
                if not depth and m[0] in ",:=":
                    break
                joint |= bool(m[0].strip())
                caller, at = "" if m[0] == "," else caller, m.end()
            elif kind == "open":
                depth, at, joint = depth + 1, m.end(), True
            elif kind == "close":
                if not depth:
                    break
                depth, at, caller, joint = depth - 1, m.end(), "", False
            elif kind == "ref" and m["ref"] in JOINTS:
                joint, at = True, m.end()
            elif not depth and not joint and text[at - 1].isspace():
                break
            elif kind == "ref":
                name, past = m["ref"], m.end()
                if first and not depth and (chained := CHAINED.match(text, past)):
                    pair.targets.append(name)
                    at = SPACE.match(text, chained.end()).end()
                    continue
                if NESTED.match(text, past):
                    return at
                if text[past : past + 1] == "(":
                    caller = name.rsplit(".", 1)[-1]
                elif not self._use(pair, name) and bare and first and DIGITS.search(name):
                    self._literal(pair, *m.span("ref"))
                at, joint = past, False
            elif kind == "braced":
                self._use(pair, m["braced"])
                at, joint = m.end(), False
            else:
                at, joint = m.end(), False
            first = False
            if depth:
                at = SPACE_AND_LINES.match(text, at).end()
        return at

    def scores(self) -> list[float]:
        """Score of each literal: the highest of all targets it reaches."""
        found = [max(map(name_score, p.targets)) * p.make.quality() for p in self.pairs]
        work = [i for i, score in enumerate(found) if score]
        while work:
            i = work.pop()
            for j in [*self.pairs[i].uses, *(self.first[u] for u in self.pairs[i].unknown if u in self.first)]:
                if found[i] > found[j]:
                    found[j] = found[i]
                    work.append(j)
        out = [0.0] * len(self.literals)
        for pair, score in zip(self.pairs, found):
            for literal in pair.literals:
                out[literal] = max(out[literal], score)
        return out


def named_spans(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of the literals that reach the threshold, in order."""
    lower = text.lower()
    if not any(stem in lower for stem in STEMS):
        return []
    lexer = Lexer(text)
    lexer.read()
    best = {}
    for span, score in zip(lexer.literals, lexer.scores()):
        best[span] = max(best.get(span, 0.0), score)
    return sorted((*span, score) for span, score in best.items() if score >= THRESHOLD)


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all spans, by start and then kind; base spans score 1."""
    base = base_spans(text)
    out, reach, i = [(*s, 1.0) for s in base], -1, 0
    for start, end, score in named_spans(text):
        while i < len(base) and base[i][1] <= start:
            reach, i = max(reach, base[i][2]), i + 1
        if end > reach:
            out.append(("named", start, end, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every row's spans, by start; offsets count code points, ends are exclusive."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    names = ["kind", "start", "end", "score"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(names, s)) for s in spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], [id_col, "spans"])

    schema = docs.select(id_col).schema.simpleString().removeprefix("struct<").removesuffix(">")
    return docs.select(id_col, text_col).mapInArrow(of, f"{schema}, spans {SPANS}")


def joined(listed: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and the hash of the base spans, and all spans in one string, for each scanned row."""
    base = F.filter("spans", lambda s: s["kind"] != "named")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    others = [c for c in scanned.columns if c != "spans"]
    return scanned.select(
        *others, *[count(k) for k in KINDS[:-1]], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
