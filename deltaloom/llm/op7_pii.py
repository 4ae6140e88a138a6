"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs their votes.

Candidates are the base's matches and looser ones of the same and of further kinds: values after words for secrets, long
tokens that look random, local and spaced phone numbers, account numbers, identity numbers, names after titles.
Pattern, gazetteer, context, shape and border labelers vote for, against or not at all. The candidates of all documents
are counted by kind, votes and features in buckets, a table of bounded size; on it EM estimates each labeler's
reliability, and a logistic span classifier is trained on features of spans and their surroundings, with the posteriors
as its labels.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty, tidy

#: The base's kinds and patterns, in the order of its results. Addresses are found from their @, and an
#: ip only where a run of digits starts, which gives the same matches in linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
IP_LIKE, DIGIT = re.compile(r"[0-9]\.[0-9]"), re.compile(r"[0-9]")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The base's kinds, and those of the method's own.
EMAIL_KIND, IP_KIND, CARD_KIND, PHONE_KIND, SECRET, IBAN, IDENTITY, NAME = range(8)
KINDS = ["email", "ip", "card", "phone", "secret", "iban", "identity", "name"]

#: Words that announce a secret, given names, titles.
SECRET_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "api key", "access_key", "access key", "credential", "private_key", "private key", "auth", "bearer", "contraseña", "passwort", "kennwort", "mot de passe")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Sra", "Monsieur", "Madame", "Mme", "my name is", "My name is")
OFFICES = {"president", "chairman", "chairwoman", "chair", "speaker", "secretary", "minister", "mayor", "ambassador", "judge", "justice", "who", "doctor", "professor", "director", "bundeskanzler", "kanzler", "ministre", "président", "presidente"}
GIVEN = {"james", "mary", "john", "maria", "robert", "anna", "michael", "linda", "david", "sarah", "peter", "laura", "thomas", "julia", "paul", "emma", "hans", "karl", "klaus", "heike", "ursula", "stefan", "jean", "pierre", "marie", "claire", "luc", "sophie", "juan", "jose", "carlos", "carmen", "luis", "ana", "pedro", "elena", "william", "elizabeth", "richard", "susan", "joseph", "jessica", "charles", "karen", "daniel", "nancy", "matthew", "margaret", "anthony", "emily", "steven", "michelle", "andrew", "amanda", "kevin", "deborah", "brian", "stephanie", "george", "rebecca", "edward", "helen", "ronald", "alice", "wolfgang", "jürgen", "dieter", "günter", "monika", "petra", "sabine", "andreas", "markus", "katrin", "birgit", "ingrid", "françois", "jacques", "michel", "philippe", "nicolas", "isabelle", "nathalie", "céline", "antonio", "manuel", "francisco", "javier", "miguel", "isabel", "lucia", "sofia", "pablo", "diego"}
#: Beginnings of secrets that services give out.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-", "AIza", "eyJ")

#: Looser candidates: kind, whether the form is specific, the pattern, the group that is the span.
OBFUSCATED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]{1,63})+")
UNICODE_MAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63})+")
NUMBER = re.compile(r"(?<![\w.+-])(?:\([0-9]{2,5}\)|[0-9])(?:[ ./-]?(?:\([0-9]{1,5}\)|[0-9])){6,18}(?![\w-])")
#: A word for a secret may go on by a plural, an underscore, a hyphen, a digit or an upper-case letter, not as another word.
VALUE = re.compile(r"(?<![A-Za-z])((?i:" + "|".join(map(re.escape, SECRET_WORDS)) + r"))(?:s|[_-][\w-]{0,40}|[A-Z0-9][\w-]{0,40})?(?![a-z])[\"']?(?:\s{0,3}(?P<sep>:=|=>|=|:)\s{0,3}|\s{1,3}(?i:is|ist|es|est)?\s{0,3})(?P<quote>[\"'`])?(?P<value>[^\s\"'`<>,;|\[\]]{6,})")
#: Words whose values are chosen by people, so that they may be words themselves.
CHOSEN = ("pass", "pwd", "contraseña", "kennwort", "mot de passe")
#: One of these is in every word for a secret.
SECRET_STEMS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "contraseña", "kennwort", "mot de passe")
LONG = re.compile(r"[A-Za-z0-9+/_=-]{20}")
RANDOM = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![\w+/=-])")
ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
NATIONAL = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
NAMED = re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.? ([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'-]{1,30}(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'-]{1,30}){0,2})(?!\w)")
FULL_NAME = re.compile(r"(?<![\w-])([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,30}) [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'-]{1,30}(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,30})?(?![\w-])")

#: Words near a span that speak for its kind.
CUES = {
    EMAIL_KIND: ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    IP_KIND: ("ip", "host", "server", "addr", "node"),
    CARD_KIND: ("card", "visa", "credit", "tarjeta", "carte", "karte", "payment"),
    PHONE_KIND: ("phone", "tel", "call", "fax", "mobile", "movil", "móvil", "handy"),
    SECRET: SECRET_WORDS,
    IBAN: ("iban", "account", "konto", "cuenta", "compte", "bank"),
    IDENTITY: ("ssn", "social security", "identity", "passport", "ausweis", "dni"),
    NAME: ("name", "dear", "signed", "contact", "sincerely"),
}
#: Words that speak against every kind.
AGAINST = ("version", "isbn", "issn", "build", "release", "section", "page", "figure", "license", "sha256", "sha1", "md5", "commit", "checksum", "order", "doi", "rfc")
#: Ends of host names, first octets of networks without hosts, first digits of card issuers, country codes.
ENDS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"}
NO_HOST = {0, 255, *range(224, 256)}
ISSUERS = ("34", "37", "36", "38", "4", "51", "52", "53", "54", "55", "2", "60", "62", "64", "65", "35")
COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98")
LABELERS = 5
#: Buckets of the features: length, share of digits, bits of a character, what stands around, cues, words against.
BUCKETS = (5, 4, 4, 3, 2, 2)


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(d: str) -> bool:
    """Whether the check digit of a run of digits holds."""
    doubled = (sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
    return (sum(map(int, d[-1::-2])) + sum(doubled)) % 10 == 0


def octet(part: str) -> bool:
    """Whether a run of digits, however long, is at most 255."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str):
    """(start, end) of the base's addresses: from each @ back over what can stand before it, then the domain."""
    pos = 0
    while (at := text.find("@", pos)) >= 0:
        local = at - pos - len(text[pos:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        pos = domain.end() if domain else at + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base's matches that pass, by start and then kind."""
    out = [(a, EMAIL_KIND, b) for a, b in emails(text)] if "@" in text else []
    if IP_LIKE.search(text):
        out += [(m.start(), IP_KIND, m.end()) for m in IP.finditer(text) if all(map(octet, m[0].split(".")))]
    if not DIGIT.search(text):
        return out
    out += [(m.start(), CARD_KIND, m.end()) for m in CARD.finditer(text) if 14 <= len(d := digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), PHONE_KIND, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


#: Dates and moments, which aren't numbers to call: year, month, day in either order, and what follows them.
DATE = re.compile(r"(?:[12][0-9]{3}([-./ ])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([-./ ])(?:0?[1-9]|[12][0-9]|3[01])\2(?:[12][0-9]{3}|[0-9]{2}))(?![0-9])")
#: Number of digits of national numbers' groups that countries in the given languages use.
GROUPS = {(3, 3, 4), (1, 3, 3, 4), (3, 3, 3), (3, 2, 2, 2), (2, 2, 2, 2, 2)}


def dated(number: str) -> bool:
    """Whether a number is a date, alone or before or after further digits."""
    return any(m.start() == 0 or m.end() == len(number) for m in DATE.finditer(number))


def counted(number: str) -> bool:
    """Whether a number is one with points for thousands, or a row of three or more round or growing ones."""
    parts = re.findall(r"[0-9]+", number)
    if len(parts) > 1 and "." in number and not re.search(r"[^0-9.]", number) and len(parts[0]) < 4 and all(len(p) == 3 for p in parts[1:]) and parts[0][0] != "0":
        return True
    even = len(parts) > 2 and len({len(p) for p in parts}) == 1 and len(parts[0]) > 2
    return even and (all(p.endswith("00") for p in parts) or parts == sorted(parts))


def national(number: str) -> bool:
    """Whether a number without a country code is grouped as numbers to call are: an area in brackets, 0, or usual groups."""
    parts = re.findall(r"[0-9]+", number)
    if "(" in number or number[0] == "0":
        return len(set(re.sub(r"[0-9() ]", "", number))) < 2
    return tuple(map(len, parts)) in GROUPS and not number.endswith("000") and len(set(re.sub(r"[0-9()]", "", number))) == 1


def secret_value(m: re.Match) -> bool:
    """Whether a value after a word for a secret can be one: a plain word is none, but as a password that is quoted or set."""
    value = m["value"].rstrip(".:!?)")
    plain = value.isalpha() and (value.islower() or value.istitle() or value.isupper()) or value.count("-") and all(p.isalpha() and p.islower() for p in value.split("-"))
    return not plain or m[1].lower().startswith(CHOSEN) and (bool(m["quote"]) or m["sep"] in ("=", ":=", "=>"))


def loose_spans(text: str):
    """(kind, specific, start, end) of the method's own candidates; they may overlap."""
    digit = DIGIT.search(text)
    if "@" in text:
        yield from ((EMAIL_KIND, False, *m.span()) for m in UNICODE_MAIL.finditer(text))
    if any(a in text for a in ("[at]", "(at)", "[AT]", "(AT)")):
        yield from ((EMAIL_KIND, True, *m.span()) for m in OBFUSCATED.finditer(text))
    for m in NUMBER.finditer(text, max(0, digit.start() - 1)) if digit else ():
        n = len(digits(m[0]))
        if dated(m[0]) or counted(m[0]):
            continue
        if 7 <= n <= 15 and not m[0].isdigit():
            yield PHONE_KIND, "(" in m[0], *m.span()
        elif 14 <= n <= 19:
            yield CARD_KIND, False, *m.span()
    low = text.lower()
    if any(w in low for w in SECRET_STEMS):
        yield from ((SECRET, bool(m["sep"]), *m.span("value")) for m in VALUE.finditer(text) if secret_value(m))
    if LONG.search(text):
        yield from ((SECRET, m[0].startswith(PREFIXES), *m.span()) for m in RANDOM.finditer(text))
    if digit and "-" in text:
        yield from ((IDENTITY, True, *m.span()) for m in NATIONAL.finditer(text))
    if digit:
        yield from ((IBAN, True, *m.span()) for m in ACCOUNT.finditer(text) if any(c.isdigit() for c in m[0][4:]))
    if any(t in text for t in TITLES):
        yield from ((NAME, True, *m.span(1)) for m in NAMED.finditer(text) if m[1].split()[0].lower() not in OFFICES)
    yield from ((NAME, True, *m.span()) for m in FULL_NAME.finditer(text) if m[1].lower() in GIVEN)


def bits(s: str) -> float:
    """Bits of a character by the frequencies in s itself."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def remainder_97(account: str) -> int:
    rest = 0
    for c in account[4:] + account[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest


def vote(yes: bool) -> int:
    return 1 if yes else -1


def seen(text: str, kind: int, start: int, end: int, base: bool, specific: bool) -> tuple[int, ...]:
    """What is counted of a candidate: kind, the labelers' votes (1 for, -1 against, 0 none), features in buckets."""
    span, d = text[start:end], digits(text[start:end])
    before, after = text[max(0, start - 40) : start].lower(), text[end : end + 25].lower()
    pattern = 1 if base or specific else 0
    gazetteer = 0
    if kind == EMAIL_KIND:
        gazetteer, shape = vote(re.split(r"[.\])]", span)[-1].strip().lower() in ENDS), vote(span.isascii() and ".." not in span)
    elif kind == IP_KIND:
        first = span.split(".", 1)[0].lstrip("0")
        gazetteer, shape = vote(len(first) < 4 and int(first or "0") not in NO_HOST), vote(not re.match(r"[.0-9]", after))
    elif kind == CARD_KIND:
        gazetteer, shape = vote(d.startswith(ISSUERS)), vote(luhn(d) and len(d) in (14, 15, 16, 19))
    elif kind == PHONE_KIND:
        gazetteer, shape = (vote(d.startswith(COUNTRIES)) if span[0] == "+" else 0), vote(len(set(d)) > 2 and (base or national(span)))
    elif kind == SECRET:
        kinds = sum(any(f(c) for c in span) for f in (str.isdigit, str.islower, str.isupper))
        given = span.startswith(PREFIXES)
        gazetteer = 1 if given else 0
        shape = vote(given and len(span) >= 16 or bits(span) >= 2.5 and kinds >= 2 and (len(d) > 0 or not span.isalnum()))
    elif kind == IBAN:
        shape = vote(remainder_97(span.replace(" ", "")) == 1)
    elif kind == IDENTITY:
        shape = vote(d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000")
    else:
        words = span.split()
        gazetteer, shape = (1 if words[0].lower() in GIVEN else 0), (1 if len(words) > 1 else 0)
    cue, against = any(c in before or c in after[:12] for c in CUES[kind]), any(c in before for c in AGAINST)
    context = -1 if against else 1 if cue else 0
    quoted = before[-1:] in ("'", '"', "`") and after[:1] == before[-1:]
    free = not re.match(r"\w", before[-1:]) and not re.match(r"\w", after[:1])
    border = 1 if quoted else 0 if free else -1
    n = len(span)
    features = (sum(n >= x for x in (10, 16, 24, 40)), min(3, 4 * len(d) // (n + 1)), min(3, max(0, int(bits(span)) - 1)), border + 1, int(cue), int(against))
    return (kind, pattern, gazetteer, context, shape, border, *features)


def spans(text: str) -> tuple[list[tuple], list[tuple]]:
    """The base's spans, and the candidates that overlap none of them: (start, kind, end, what is counted)."""
    base = base_spans(text)
    told = [(s, k, e, seen(text, k, s, e, True, True)) for s, k, e in base]
    starts, ends, most = [s for s, _, _ in base], [], 0
    for _, _, e in base:
        most = max(most, e)
        ends.append(most)
    free: dict[tuple[int, int, int], bool] = {}
    for kind, specific, a, b in loose_spans(text):
        i = bisect_right(starts, b - 1)
        if not i or ends[i - 1] <= a:
            free[a, kind, b] = free.get((a, kind, b), False) or specific
    return told, [(a, kind, b, seen(text, kind, a, b, False, specific)) for (a, kind, b), specific in sorted(free.items())]


def _patterns(batches):
    for batch in batches:
        counts: dict[tuple, int] = {}
        for text in batch.column(0):
            base, free = spans(text.as_py())
            for *_, p in (*base, *free):
                counts[p] = counts.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in counts], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"])


#: What is believed of a labeler before any candidate is seen: right and wrong votes on real spans, and on others.
RIGHT, WRONG = 8.0, 2.0
#: Least and largest share of right votes: a labeler's vote for a span never speaks against it, and none decides alone.
LEAST, MOST = 0.55, 0.995


def estimate(table: dict[tuple, int], rounds: int = 100) -> dict[tuple, float]:
    """Posterior that a candidate of each pattern is personal data.

    Each kind has a share of real spans; each labeler, where it votes at all, is right on a share of real spans and on a
    share of others, alike for all kinds. That it doesn't vote tells nothing. EM starts with the sum of votes; what is
    believed beforehand is added to the counts, and shares stay in their bounds, so that no labeler changes sides.
    """
    if not table:
        return {}
    keys = sorted(table)
    n = np.array([table[k] for k in keys], np.float64)
    kind = np.array([k[0] for k in keys])
    v = np.array([k[1 : 1 + LABELERS] for k in keys])
    p = 1 / (1 + np.exp(-1.5 * v.sum(axis=1)))
    for _ in range(rounds):
        real, other = (n * p)[:, None], (n * (1 - p))[:, None]
        right = lambda w, side: np.clip(((w * (v == side)).sum(axis=0) + RIGHT) / ((w * (v != 0)).sum(axis=0) + RIGHT + WRONG), LEAST, MOST)
        a, b = right(real, 1), right(other, -1)
        weight = np.where(v == 1, np.log(a / (1 - b)), np.where(v == -1, np.log((1 - a) / b), 0.0)).sum(axis=1)
        share = np.array([((n * p)[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(KINDS))])[kind]
        p = 1 / (1 + np.exp(-np.clip(weight + np.log(share / (1 - share)), -500, 500)))
    return dict(zip(keys, p.tolist(), strict=True))


def _inputs(keys: list[tuple]) -> np.ndarray:
    """A constant, the kind, whether the form is specific, and every feature's bucket, alone and with the kind."""
    width = 2 + len(KINDS) + sum(BUCKETS) * (1 + len(KINDS)) + 3 * len(KINDS)
    x = np.zeros((len(keys), width))
    for i, k in enumerate(keys):
        kind, shape = k[0], k[4]
        x[i, 0] = x[i, 2 + kind] = 1
        x[i, 1] = k[1]
        at = 2 + len(KINDS)
        for bucket, many in zip(k[1 + LABELERS :], BUCKETS, strict=True):
            x[i, at + bucket] = x[i, at + many * (1 + kind) + bucket] = 1
            at += many * (1 + len(KINDS))
        x[i, at + 3 * kind + shape + 1] = 1
    return x


def train(table: dict[tuple, int], posterior: dict[tuple, float]) -> np.ndarray:
    """Weights of the logistic span classifier: Newton steps on the posteriors as soft labels."""
    x = _inputs(sorted(table))
    w = np.zeros(x.shape[1])
    if not table:
        return w
    keys = sorted(table)
    n, y = np.array([table[k] for k in keys], np.float64), np.array([posterior[k] for k in keys])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + 0.1 * w
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return w


def fit(docs: DataFrame) -> np.ndarray:
    """The span classifier's weights from all documents; the driver gets the counts of a bounded set of patterns."""
    counted = docs.select(text_or_empty().alias("text")).mapInArrow(tidy(_patterns), "pattern array<int>, n long")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    table = {tuple(r["pattern"]): r["n"] for r in rows}
    return train(table, estimate(table))


def found(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base's spans, and all spans: the base's and those that the classifier accepts.

    Of accepted ones that overlap the one that starts first stays, of those the one of the first kind; secrets that overlap
    are one, from the first one's start to the last one's end, so that no part of one is left.
    """
    told, free = spans(text)
    base = [x[:3] for x in told]
    if not free:
        return base, base
    score = _inputs([x[3] for x in free]) @ weights
    own, to = [], -1
    for x, s in zip(free, score.tolist(), strict=True):
        if s >= 0 and x[0] >= to:
            own.append(x[:3])
            to = x[2]
        elif s >= 0 and x[1] == own[-1][1] == SECRET and x[2] > to:
            own[-1] = (*own[-1][:2], x[2])
            to = x[2]
    return base, sorted([*base, *own])


def joined(items: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in items)


def _find(weights):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text"):
                    base, every = found(text.as_py(), weights)
                    n = [0] * 4
                    for _, k, _ in base:
                        n[k] += 1
                    rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), sum(k == SECRET for _, k, _ in every), len(every)))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret", "n_spans"])

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_spans.

    The first counts are the base's, n_secret and n_spans those of all spans. Null and empty texts have none; a text of
    any length is read whole, in linear time. Repeated rows give a row each, null doc_ids included; other columns are
    ignored. The base's spans may overlap each other; those of the method's own overlap none. An empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(tidy(_find(fit(docs))), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_spans long")


def _redact(weights):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for text in batch.column(at).to_pylist():
                if text:
                    out, last = [], 0
                    for s, k, e in found(text, weights)[1]:
                        if e > last:
                            out += [text[last:s], f"[{KINDS[k]}]"] if s >= last else []
                            last = e
                    text = "".join([*out, text[last:]]) if last else text
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return run


def redacted(docs: DataFrame) -> DataFrame:
    """All rows of docs with every span replaced by its kind in brackets; n_chars, where there is one, follows."""
    out = docs.mapInArrow(tidy(_redact(fit(docs))), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
