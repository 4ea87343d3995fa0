"""Personal data by a character-level bidirectional LSTM with CRF transitions, beside exact base patterns.

Base spans follow fixed patterns for e-mail addresses, IP addresses, card and phone numbers. The tagger is trained
here, in numpy, on windows of text around digits and at-signs whose labels come from the base patterns, together with
rewritten forms of the spans that the patterns don't know (no plus sign, other separators, a spelled-out at-sign) and
look-alikes that are none (times, dates, versions, hexadecimal tokens). It reads every place of every text that has a
digit or an at-sign, in overlapping windows on a fixed grid; each character takes the label of the window in whose
middle half it lies, and spans are formed on the joined labels, so that a span across windows is found once. A span
of the tagger is added where it touches no base span and its digits or parts hold what the kind demands.

Training takes at most ``sample`` texts, or pieces of longer ones, of at most ``characters`` each, in the order of a
hash; tagging reads all.

Defined cases: null and empty texts have no spans; offsets count code points, ends are exclusive; base kinds may
overlap each other; without any labelled span in the sample the tagger is not trained and adds nothing.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded
from shopscope.llm.char_tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
# The base patterns. An address is matched from its at-sign to the right; to the left it takes all it may.
# The first match of a number pattern from any place begins with a whole run of digits, so only these places are tried.
EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
RUN = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Window length and grid; the middle half of a window is its own.
WINDOW, GRID = 64, 32
#: Spelled-out signs of an address, in either case; a bare "at" only before what looks like a domain.
AT = r"(?:@|[(\[{] ?at ?[)\]}]|(?<=\w )at(?= [\w-]+(?:\.[\w-]| dot )))"
DOT = r"(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )"
TRIGGER = re.compile(f"[0-9]|{AT}", re.I)
AT_SIGN = re.compile(AT, re.I)
BRACKETED = re.compile(r"[(\[{] ?at ?[)\]}]", re.I)
DOMAIN = re.compile(rf" ?[\w-]+(?:{DOT}[\w-]+)*", re.I)
ADDRESS = re.compile(rf"[\w.%+-]+ ?{AT} ?[\w-]+(?:{DOT}[\w-]+)+", re.I)
LABELS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))
# Symbols of the tagger; digits but 0, letters by case, other letters and other signs each share one.
SIGNS = "@.+-_()[]%:/,;!?#\"'=<> \n\t0"
SYMBOLS = 5 + len(SIGNS)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        digit = digit * 2 if place % 2 else digit
        total += digit - 9 if digit > 9 else digit
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in EMAIL_LEFT:
            start -= 1
        match = EMAIL_RIGHT.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None, strict: bool = True) -> list[Span]:
    """Spans of the base patterns by start, then kind; without ``strict``, cards needn't pass their checksum."""
    if not text:
        return []
    found = list(_emails(text)) if "@" in text else []
    after_ip = after_card = 0
    for run in RUN.finditer(text):
        start, end = run.span()
        if start >= after_ip and text[end : end + 1] == "." and (match := IP.match(text, start)):
            after_ip = match.end()
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match[0].split(".")):
                found.append((start, after_ip, "ip"))
        if start >= after_card and (match := CARD.match(text, start)):
            after_card = match.end()
            digits = digits_of(match[0])
            if 12 <= len(digits) <= 19 and (not strict or luhn(digits)):
                found.append((start, after_card, "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- windows -----------------------------------------------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    table = np.full(0x250, 4, np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c in SIGNS:
            table[code] = 5 + SIGNS.index(c)
        elif c.isascii() and c.isdigit():
            table[code] = 1
        elif c.isascii() and c.isalpha():
            table[code] = 2 if c.islower() else 3
        elif c.isalpha():
            table[code] = 0
    return table


TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return TABLE[np.minimum(codes, len(TABLE) - 1)]


def reach(text: str, start: int, end: int) -> tuple[int, int]:
    """How far the address characters around an at-sign go."""
    left = start - (text[start - 1 : start] == " ")
    while left and (text[left - 1].isalnum() or text[left - 1] in "_.%+-"):
        left -= 1
    domain = DOMAIN.match(text, end)
    return min(left, start), domain.end() if domain else end


def window_starts(text: str) -> list[int]:
    """Grid windows that hold a trigger, each of which lies in two of them but at the text's start, or what an at-sign reaches."""
    starts: set[int] = set()
    for match in TRIGGER.finditer(text):
        cell = match.start() // GRID
        starts.update((cell * GRID, (cell - 1) * GRID))
        if not "0" <= match[0] <= "9":
            left, right = reach(text, *match.span())
            quarter = (WINDOW - GRID) // 2
            starts.update(range((left - 1 - quarter) // GRID * GRID, (right - quarter) // GRID * GRID + 1, GRID))
    return sorted(starts)


def cut_windows(text: str, starts: Iterable[int]) -> np.ndarray:
    """The symbols of each window; places outside the text count as line feeds. Starts ascend, and may begin at -GRID.

    Only the stretch that the windows cover is coded, so that a long text's runs of windows take linear time.
    """
    starts = list(starts)
    low = max(0, starts[0])
    covered = symbols(text[low : max(low, starts[-1] + WINDOW)])
    padded = np.full(starts[-1] - low + 3 * WINDOW, 5 + SIGNS.index("\n"), TABLE.dtype)
    padded[WINDOW : WINDOW + len(covered)] = covered
    return np.stack([padded[s - low + WINDOW : s - low + 2 * WINDOW] for s in starts])


def join(starts: list[int], labels: np.ndarray) -> list[Span]:
    """Spans over the windows' middle halves, joined; a place outside all of them has no label."""
    found: list[Span] = []
    kind, begin, last = None, 0, -2
    quarter = (WINDOW - GRID) // 2
    for start, row in zip(starts, labels):
        for place in range(start + quarter, start + quarter + GRID):
            label = int(row[place - start])
            own = KINDS[(label - 1) // 2] if label else None
            if kind is not None and (own != kind or label % 2 == 1 or place != last + 1):
                found.append((begin, last + 1, kind))
                kind = None
            if own is not None:
                if kind is None:
                    kind, begin = own, place
                last = place
    if kind is not None:
        found.append((begin, last + 1, kind))
    return found


def whole(text: str, span: Span) -> Span:
    """The span with the bracket that opens its first group, where the tagger has begun after it; an address with all
    its at-sign reaches, as the base pattern has it."""
    start, end, kind = span
    if kind == "email" and (sign := AT_SIGN.search(text, max(0, start), max(0, end))):
        left, right = reach(text, *sign.span())
        while left < sign.start() and text[left] in ".%+-":
            left += 1
        return min(start, left), max(end, right), kind
    opens = kind == "phone" and start > 0 and text[start - 1] == "(" and text[start:end].count(")") > text[start:end].count("(")
    return start - opens, end, kind


def plausible(text: str, span: Span) -> bool:
    """Whether what the tagger found holds what its kind demands."""
    start, end, kind = span
    if start < 0 or end > len(text):
        return False
    part, digits = text[start:end], digits_of(text[start:end])
    if kind == "email":
        return (match := ADDRESS.match(text, start)) is not None and match.end() == end
    outside = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
    if not outside or not part[0].isalnum() and part[0] not in "(+" or not part[-1].isdigit():
        return False
    if kind == "ip":
        parts = re.split(r" ?\. ?", part)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return re.fullmatch(r"[0-9]{4}([ ./_-]?)(?:[0-9]{4}\1){2}[0-9]{1,7}|[0-9]{4}([ ./_-])[0-9]{6}\2[0-9]{5}", part) is not None and 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and re.fullmatch(r"\+?[0-9() ./-]+", part) is not None


def bracketed(text: str) -> Iterator[Span]:
    """Addresses with an at-sign spelled out in brackets: unlike a bare "at", these need no tagger."""
    for sign in BRACKETED.finditer(text):
        span = whole(text, (*sign.span(), "email"))
        if plausible(text, span):
            yield span


class Finder:
    """Base spans and those the tagger adds."""

    def __init__(self, tagger: Tagger | None):
        self.tagger = tagger

    def added(self, texts: list[str | None], base: list[list[Span]], strip: int = 4096) -> list[list[Span]]:
        """The tagger's own spans of each text, and bracketed addresses."""
        apart = lambda n, s: not any(s[0] < e and b < s[1] for b, e, _ in base[n])
        more = [[s for s in bracketed(text or "") if apart(n, s)] for n, text in enumerate(texts)]
        if self.tagger is None:
            return more
        held: list[tuple[int, list[int], np.ndarray]] = []
        count = 0

        def flush() -> None:
            nonlocal count
            if not held:
                return
            windows, owners = np.unique(np.concatenate([w for _, _, w in held]), axis=0, return_inverse=True)
            labels, at = self.tagger.decode(windows)[owners.reshape(-1)], 0
            for n, starts, own in held:
                spans = dict.fromkeys(whole(texts[n], s) for s in join(starts, labels[at : at + len(own)]))
                at += len(own)
                more[n] += [s for s in spans if s not in more[n] and apart(n, s) and plausible(texts[n], s)]
            held.clear()
            count = 0

        for n, text in enumerate(texts):
            if not text or not (starts := window_starts(text)):
                continue
            # cut where a gap ends a run of windows, so that one long text needn't be held at once
            run: list[int] = []
            for start in starts:
                if run and start != run[-1] + GRID and len(run) >= 256:
                    held.append((n, run, cut_windows(text, run)))
                    count, run = count + len(run), []
                    if count >= strip:
                        flush()
                run.append(start)
            held.append((n, run, cut_windows(text, run)))
            count += len(run)
            if count >= strip:
                flush()
        flush()
        return more

    def find(self, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text, by start and kind."""
        base = [base_spans(t) for t in texts]
        return [(b, sorted(b + m, key=lambda s: (s[0], KINDS.index(s[2])))) for b, m in zip(base, self.added(texts, base))]


# ---- training ----------------------------------------------------------------------------------------------------


def rewritten(part: str, kind: str, rng: random.Random) -> tuple[str, int, int]:
    """Another form of a span's text, and which part of it is the span."""
    digits = digits_of(part)
    if kind == "email":
        text = part.replace("@", rng.choice(["@", " (at) ", "[at]", " [at] ", "(at)", "(AT)", "{at}", " {at} ", " [AT] ", " at "]))
    elif kind == "phone":
        local = digits[-10:] if rng.random() < 0.5 else "".join(rng.choices("0123456789", k=10))
        a, b, c = local[:3], local[3:6], local[6:]
        text = rng.choice([part, part, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{digits[:2]} {a} {b} {c}", f"{a} {b} {c}", f"0{a} {b}{c}", f"0{a}/{b}{c}", f"(0{a[1:]}) {b}{c}", f"({a}) {b}{c}", f"{a}-{b}{c}", f"0{a[1:]}{b}{c}"])
    elif kind == "card":
        text = rng.choice([part, part, *(s.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for s in " -./")])
    else:
        text = rng.choice([part, part, part.replace(".", " . "), part.replace(".", ". ")])
    before, after = rng.choice([("", ""), ("", ""), ("(", ")"), ("", ","), ("", "."), ("", "!!"), (": ", ""), ('"', '"')])
    return before + text + after, len(before), len(before) + len(text)


def look_alike(rng: random.Random) -> str:
    n = lambda low, high: str(rng.randint(low, high))
    return rng.choice(
        [
            f"{n(1, 12)}:{n(10, 59)}",
            f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}",
            f"{n(1, 28)}.{n(1, 12)}.{n(1990, 2030)}",
            f"{n(1, 9)}.{n(0, 9)}.{n(0, 20)}",
            f"version {n(1, 9)}.{n(0, 9)}",
            "".join(rng.choices("0123456789abcdef", k=rng.randint(16, 40))),
            "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=20)),
            f"{n(1, 99)},{n(100, 999)},{n(100, 999)}",
            f"@{rng.choice(['home', 'news', 'you'])}",
            f"{rng.choice(['it', 'look', 'more'])} at {rng.choice(['www.example.org', 'example.com', 'home.'])}",
            n(1, 9_999_999),
            n(10**8, 10**14),
            n(1_000_000_000, 1_800_000_000),
            f"{n(1, 99999)}.{n(10**5, 10**9)}",
            f"{n(10**5, 10**7)}-{n(10**5, 10**7)}",
            f"{n(1, 9)},{n(100, 999)},{n(100, 999)},{n(100, 999)}",
            f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
            f"{n(1990, 2030)}{n(10, 12)}{n(10, 28)}{n(100000, 235959)}",
            f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)} {n(10, 23)}{n(10, 59)}",
            f"{n(1990, 2030)} {n(1990, 2030)} {n(1990, 2030)}",
        ]
    )


def training_windows(texts: list[str], seed: int = 11, each: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels: of the texts as they are, and with spans rewritten or replaced by look-alikes.

    Phone numbers and addresses have the most forms, so their surroundings are taken again with some of them and look-alikes.
    """
    rng, xs, ys = random.Random(seed), [], []
    whole_texts = []
    for text in texts:
        spans = base_spans(text, strict=False)
        spans = [s for n, s in enumerate(spans) if not n or s[0] >= spans[n - 1][1]]
        whole_texts.append((text, spans, range(3 if spans else 1)))
    around, taken = [], dict.fromkeys(KINDS, 0)
    for text, spans, _ in whole_texts:
        for n, (start, end, kind) in enumerate(spans):
            if kind in ("phone", "email") and taken[kind] < each:
                taken[kind] += 1
                low = max(start - WINDOW, spans[n - 1][1] if n else 0)
                high = min(end + WINDOW, spans[n + 1][0] if n + 1 < len(spans) else len(text))
                around.append((text[low:high], [(start - low, end - low, kind)], [1, 3] * (6 if kind == "phone" else 4)))
    for text, spans, versions in whole_texts + around:
        for version in versions:
            parts: list[str] = []
            labels: list[int] = []
            at = 0
            for start, end, kind in spans:
                parts.append(text[at:start])
                labels += [0] * (start - at)
                first = 1 + 2 * KINDS.index(kind)
                if version == 0:
                    piece, a, b = text[start:end], 0, end - start
                elif version == 3 or version == 2 and rng.random() < 0.5:
                    piece, a, b = look_alike(rng), 0, 0
                else:
                    piece, a, b = rewritten(text[start:end], kind, rng)
                parts.append(piece)
                labels += [first if n == a < b else first + 1 if a < n < b else 0 for n in range(len(piece))]
                at = end
            parts.append(text[at:])
            labels += [0] * (len(text) - at)
            made = "".join(parts)
            starts = window_starts(made)
            if starts:
                gold = np.zeros(len(made) + 3 * WINDOW, np.int64)
                gold[WINDOW : WINDOW + len(made)] = labels
                xs.append(cut_windows(made, starts))
                ys.append(np.stack([gold[s + WINDOW : s + 2 * WINDOW] for s in starts]))
    if not xs:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(xs), np.concatenate(ys)


def fit(texts: list[str], windows: int = 4000, epochs: int = 10, hidden: int = 16) -> Finder:
    x, y = training_windows(texts)
    if not y.any():
        return Finder(None)
    order = np.random.default_rng(2).permutation(len(x))
    # windows without a span keep a third of the room
    held, free = order[y[order].any(1)], order[~y[order].any(1)]
    held = held[: max(windows - len(free), windows * 2 // 3)]
    order = np.concatenate([held, free])[:windows]
    tagger = Tagger.fresh(SYMBOLS, len(LABELS), hidden)
    tagger.train(x[order], y[order], max(epochs, min(4 * epochs, epochs * windows // len(order))))
    return Finder(tagger)


def learn(docs: DataFrame, sample: int = 1200, characters: int = 6000) -> Finder:
    """Train on a bounded sample of the texts, or pieces of longer texts, that hold a digit or an at-sign."""
    pieces = F.when(F.length("text") <= characters, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{characters}}}"), F.lit(0)))
    cut = docs.where(F.col("text").rlike("[0-9@]")).select(F.explode(pieces).alias("text"))
    fitting = cut.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("order"))
    # hashes first, so that no task sends more texts than are wanted in all
    last = fitting.select("order").distinct().orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    rows = fitting.where(F.col("order") <= F.lit(last).cast("long")).dropDuplicates(["order"]).orderBy("order").collect()
    return fit([row["text"] for row in rows])


# ---- columns -----------------------------------------------------------------------------------------------------


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind."""
    if not spans:
        return text
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _slices(batch: pd.Series, size: int = 8 << 20) -> Iterator[list[str | None]]:
    held, used = [], 0
    for value in batch:
        if held and used + len(value or "") > size:
            yield held
            held, used = [], 0
        held.append(value)
        used += len(value or "")
    yield held


def spans(text: Column, finder: Finder) -> Column:
    """Struct of the base spans' counts by kind, the digest of the base spans, and all spans."""
    bounded()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)

    @F.pandas_udf(f"{counts}, base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for texts in _slices(batch):
                for base, every in finder.find(texts):
                    numbers = [sum(kind == k for _, _, kind in base) for k in KINDS]
                    rows.append((*numbers, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
            yield pd.DataFrame(rows, columns=[*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return found(text)


def redact(text: Column, finder: Finder) -> Column:
    """The text without its personal data."""
    bounded()

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([redacted(t, every) for texts in _slices(batch) for t, (_, every) in zip(texts, finder.find(texts))], dtype=object)

    return clean(text)
