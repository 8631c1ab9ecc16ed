"""Operator 7, personal data: base patterns, then candidates chosen by gradient-boosted trees.

Base spans follow fixed patterns and checks. Beside them, generators of high recall propose overlapping spans (long tokens
with a digit, issued keys, assigned passwords, national numbers of 7 to 15 digits however divided, long digit groups,
disguised or spelled addresses, IPv6, bank account and social security numbers). Boosted trees of depth two score each
candidate by its format and the text around it; a threshold for each kind, calibrated on examples that the trees were not
fitted on, selects those to redact. Trees travel as a constant array of nodes, so every document is scored within its row by
SQL functions: nothing shuffles, and no row is treated unlike another.

Places are running sums that are folded in blocks, so a text of many matches takes time by its size to the power of 1.5.

Positions come from the texts between matches, so they count code points. Patterns use possessive repeats and start only
where a run of their characters starts, so the longest texts stay linear and need no deep stack.

Defined results: null and empty texts have no spans (counts 0, empty strings, the hash of the empty string); repeated rows
and null ids are each scanned; an empty table gives no rows. A candidate that overlaps a base span is not added.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import let, row_of, table

_LOCAL = "A-Za-z0-9._%+-"
_BYTE = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Base patterns in the order of their kinds: the contract's, with starts and repeats that cannot backtrack.
BASE = {
    "email": f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){15,18}(?![\\x20-]?[0-9])",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: A pattern that a text must contain for its kind to be looked for.
NEED = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
_AT, _DOT = "(?:at|AT|At|@|arroba|arobase|\u00e4t)", "(?:dot|DOT|Dot|punto|point|punkt|Punkt)"
_BOXED_AT, _BOXED_DOT = (f"[\\[(<{{]\\x20?{x}\\x20?[\\])>}}]" for x in (_AT, _DOT))
_IPV6 = "(?:[0-9A-Fa-f]{0,4}:){2,8}(?:[0-9A-Fa-f]{1,4}|(?<=::))"
_PASSWORD = "password|passwd|pwd|passwort"
#: Generators of candidates.
CANDIDATES = {
    "email": (
        f"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+(?:\\x20?{_BOXED_AT}\\x20?|\\x20{_AT}\\x20|\\x20@|@\\x20)[A-Za-z0-9-]++"
        f"(?:(?:\\x20?{_BOXED_DOT}\\x20?|\\x20{_DOT}\\x20|\\x20?\\.\\x20?)[A-Za-z0-9-]++)++"
    ),
    "ip": f"(?<![A-Za-z0-9:.]){_IPV6}(?![A-Za-z0-9]|:[0-9A-Fa-f:])",
    "card": "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){12,18}(?![\\x20-]?[0-9])",
    "phone": (
        "(?<![0-9+])(?<!\\+[0-9]\\x20)(?:\\([0-9]{3}\\)\\x20?|[0-9]{3}[\\x20.-])[0-9]{3}[\\x20.-][0-9]{4}(?![0-9])"
        "|(?<![0-9A-Za-z_+])(?<![0-9][\\x20./-])\\(?[0-9](?:[\\x20./()-]{0,2}[0-9]){6,14}+(?![0-9A-Za-z_]|[\\x20./-][0-9])"
    ),
    "secret": (
        "(?<![A-Za-z0-9_/+.-])eyJ[A-Za-z0-9_-]{5,}+\\.[A-Za-z0-9_-]{5,}+(?:\\.[A-Za-z0-9_-]++)?"
        "|(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{16,}+"
    ),
    "iban": "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}+(?:\\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ssn": "(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "password": f"(?<=(?i:{_PASSWORD})\\x20?[:=]\\x20?[\"']?)[^\\s\"',;:=]{{6,64}}+",
}
NEED_CANDIDATE = {
    "email": f"{_BOXED_AT}|\\x20@|@\\x20|\\x20{_AT}\\x20[A-Za-z0-9-]++(?:\\x20{_DOT}\\x20|\\x20?{_BOXED_DOT}|\\x20?\\.\\x20?[A-Za-z0-9-])",
    "ip": ":[0-9A-Fa-f]{0,4}:", "card": "[0-9]{2}", "phone": "[0-9][\\x20./()-]{0,2}[0-9]", "secret": "[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}", "password": "(?i:passw|pwd)",
}
KINDS = ["email", "ip", "card", "phone", "secret", "iban", "ssn", "password"]
SPAN = "array<struct<s:int,e:int,m:string,b:string,a:string>>"


def running(values: Column, step: Callable[[Column, Column], Column], zero: int) -> Column:
    """``step`` folded over each prefix of an array of integers. An append copies its array, so folds run in blocks of the root of its size."""
    none = F.array().cast("array<int>")

    def fold(part: Column) -> Column:
        start = F.struct(F.lit(zero).alias("v"), none.alias("out"))
        grow = lambda acc, x: F.struct(step(acc["v"], x).alias("v"), F.array_append(acc["out"], step(acc["v"], x)).alias("out"))
        return F.aggregate(part, start, grow, lambda acc: acc["out"])

    def joined(inner: Column) -> Column:
        before = F.concat(F.array(F.lit(zero)), fold(F.transform(inner, lambda p: F.element_at(p, -1))))
        return F.flatten(F.zip_with(inner, F.slice(before, 1, F.size(inner)), lambda p, y: F.transform(p, lambda x: step(y, x))))

    def blocks(v: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(v), block), lambda i: fold(F.slice(v, i, block)))

    return let(values, lambda v: F.when(F.size(v) == 0, none).otherwise(let(blocks(v), joined)))


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, end, match, and the text before and after, in code points."""

    def place(m: Column, g: Column) -> Column:
        ends = running(F.zip_with(m, F.slice(g, 1, F.size(m)), lambda x, y: F.length(x) + F.length(y)), lambda x, y: x + y, 0)
        one = lambda e, i: F.struct((e - F.length(F.get(m, i))).alias("s"), e.alias("e"), F.get(m, i).alias("m"), F.right(F.get(g, i), F.lit(24)).alias("b"), F.left(F.get(g, i + 1), F.lit(8)).alias("a"))
        return F.transform(ends, one)

    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(every, lambda m: F.when(F.size(m) == 0, F.array().cast(SPAN)).otherwise(let(F.split(text, pattern, -1), lambda g: place(m, g))))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    value = lambda i: F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
    total = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda acc, i: acc + let(value(i), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return total % 10 == 0


def _base_ok(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(f"^(0*{_BYTE}\\.){{3}}0*{_BYTE}$")
    if kind == "card":
        return luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return F.lit(True)


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def base_spans(text: Column, kind: str) -> Column:
    found = F.when(text.rlike(NEED[kind]), F.filter(located(text, BASE[kind]), lambda x: _base_ok(kind, x["m"])))
    return F.coalesce(_named(kind, found), F.array().cast("array<struct<k:int,s:int,e:int>>"))


#: Features of a candidate: counts of its format and marks of its context, all small integers.
FEATURES = ["length", "digits", "upper", "lower", "breaks", "hex", "luhn", "assigned", "secret_word", "phone_word", "card_word", "quoted", "disguised", "date", "number_word", "mail_word", "domain", "spelled", "spaced", "stop", "ipv6", "ip_word", "colons", "sign", "marked", "mod97", "id_word", "marks"]
_PHONE_WORD = (
    "(?<!\\p{L})(?:tel|t\u00e9l|telef|telephone|t\u00e9l\u00e9phone|telephone|telefon|telefono|tel\u00e9fono|telefonnummer|rufnummer|phone|call|calls|called|calling|fax|mobile|mobil|mobiltelefon|movil|m\u00f3vil|cell|cellphone|dial|ring|sms|whatsapp"
    "|handy|handynummer|anruf|anrufen|ruf|rufen|appel|appelez|appeler|appelle|portable|llame|llama|llamar|ll\u00e1manos|celular)(?!\\p{L})[^0-9]*$"
)
_DATE = "^(?:(?:19|20)[0-9]{2}[-./\\x20]?(?:0?[1-9]|1[0-2])[-./\\x20]?[0-3]?[0-9](?![0-9])|[0-3]?[0-9][-./\\x20][0-3]?[0-9][-./\\x20](?:19|20)[0-9]{2}(?![0-9]))"
_DOMAIN = "(?:\\.|(?:dot|punto|point|punkt)\\x20|[\\])>}]\\x20?)(?:com|org|net|edu|gov|mil|info|biz|io|dev|app|eu|de|fr|es|uk|us|it|nl|ch|at|ca|be|pt|mx|ar|co|br|jp|example|test|invalid)$"


#: Openings of tokens that services issue.
_MARKED = "^(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|xox[abp]-|sk[-_]|AIza|eyJ)"


def mod97(number: Column) -> Column:
    """Remainder by 97 of an account number, its first four characters last and letters as 10 to 35."""
    plain = F.regexp_replace(number, "\\x20", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = lambda c: F.ascii(c) - F.when(F.ascii(c) >= 65, 55).otherwise(48)
    step = lambda acc, c: (acc * F.when(F.ascii(c) >= 65, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def features(kind: str, x: Column) -> Column:
    """Array of the features of a located candidate."""
    count = lambda rx: F.regexp_count(x["m"], F.lit(rx))
    flag = lambda c: c.cast("int")
    before = F.lower(x["b"])
    number = digits(x["m"])
    only = lambda k, c: c if kind == k else F.lit(0)
    number_word = flag(before.rlike("(?<!\\p{L})(?:isbn|issn|order|serial|total|id|rows|sum|pages|code|lot|invoice|ref|version|zip|date|part|item|model|no)[\\s.:#]*$"))
    six = x["m"].rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | (x["m"].rlike("^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?$") & (F.regexp_count(x["m"], F.lit("[0-9A-Fa-f]+")) <= 7))
    return F.array(
        F.length(x["m"]), F.length(number), count("[A-Z]"), count("[a-z]"), count("[\\x20().-]"), flag(x["m"].rlike("^[0-9a-f]+$")), only("card", flag(luhn(number))),
        flag(before.rlike("[=:]\\s*[\"']?$")), flag(before.rlike("(token|secret|passw(or)?d|pwd|api.?key|access.?key|credential)")), only("phone", flag(before.rlike(_PHONE_WORD))),
        flag(before.rlike("(card|visa|credit|debit|pan\\b|payment)")), flag(before.rlike("[\"']$") & x["a"].rlike("^[\"']")), only("email", flag(x["m"].rlike(_BOXED_AT))),
        only("phone", flag(x["m"].rlike(_DATE))), only("phone", number_word) if kind != "ssn" else number_word,
        only("email", flag(before.rlike("(?<!\\p{L})(?:e-?mails?|mail|mails|mailto|contact|kontakt|contacto|correo|courriel|write to|reach)(?!\\p{L})"))), only("email", flag(F.lower(x["m"]).rlike(_DOMAIN))),
        only("email", flag(x["m"].rlike(f"\\x20{_DOT}\\x20|{_BOXED_DOT}"))), only("email", flag(x["m"].rlike("\\.\\x20|\\x20\\."))),
        only("email", flag(F.lower(x["m"]).rlike(f"(?:{_AT}|[\\])>}}])\\x20?(?:the|a|an|this|that|each|every|any|one|no|my|your|his|her|its|our|their|last|least|first|all)[\\x20.]"))),
        only("ip", flag(six)), only("ip", flag(before.rlike("(?<!\\p{L})(?:ip|ipv6|inet6|host|addr|address|adresse|server|client|peer|ping|from)(?!\\p{L})[^0-9]*$"))), only("ip", count(":")), only("email", flag(x["m"].contains("@"))),
        only("secret", flag(x["m"].rlike(_MARKED))), only("iban", flag(mod97(x["m"]) == 1)), only("ssn", flag(before.rlike("(?:ssn|social security|security number|social|tax id)[^0-9]*$"))), only("password", count("[^\\p{L}0-9]")),
    )


def examples(seed: int = 7, each: int = 40) -> list[tuple[str, str, int]]:
    """Labelled texts made by rule: kind of the candidate, a text that holds one, 1 for personal data."""
    r = random.Random(seed)
    some = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    low, dig = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    hexa, mixed = dig + "abcdef", dig + low + low.upper()
    word = lambda: some(low, r.randint(3, 8)) + "q"  # noqa: E731  never a word that features look for
    token = lambda chars, n: (lambda t: t if any(c in dig for c in t) else t[:-1] + r.choice(dig))(some(chars, n))  # noqa: E731  with a digit
    out = []
    for _ in range(each):
        quote = r.choice(['"', "'", ""])
        name = r.choice(["token", "secret", "api_key", "password", "access_key", "api key", "credential"])
        out.append(("secret", f"{word()} {name} {r.choice('=:')} {quote}{token(hexa, r.choice([18, 32, 40, 64]))}{quote} {word()}", 1))
        out.append(("secret", f"{word()} {name}{r.choice('=:')}{quote}{token(mixed, r.randint(16, 46))}{quote} {word()}", 1))
        out.append(("secret", f"{word()} {word()} {r.choice(['AKIA', 'ASIA'])}{token(dig + low.upper(), 16)} {word()}", 1))
        out.append(("secret", f"{word()} {word()} {r.choice(['ghp_', 'glpat-', 'xoxb-', 'sk-'])}{token(mixed, r.randint(20, 40))} {word()}", 1))
        out.append(("secret", f"{word()} {word()} eyJ{some(mixed, 30)}.eyJ{some(mixed, 40)}.{some(mixed, 43)} {word()}", 1))
        out.append(("password", f"{word()} {r.choice(['password', 'Password', 'pwd', 'passwd'])}{r.choice([': ', '=', ' = '])}{quote}{some(low, r.randint(4, 9))}{r.choice(['1', '42', '!', '2024', '#7'])}{quote} {word()}", 1))
        out.append(("password", f"{word()} {r.choice(['password:', 'Password:', 'pwd ='])} {some(low, r.randint(5, 9))}q {word()}", 0))
        out.append(("secret", f"{word()} {r.choice(['commit', 'sha256', 'file', 'md5', 'page', 'commit:', 'md5 ='])} {token(hexa, r.choice([18, 32, 40, 64]))} {word()}", 0))
        out.append(("secret", f"{word()} {word()} {token(mixed, r.randint(16, 46))} {word()}", 0))
        out.append(("secret", f"{word()} {some(low, 12)}7{some(low, 8)} {word()}", 0))
        out.append(("secret", f"{word()} {some(dig, r.randint(16, 20))} {word()}", 0))
        out.append(("secret", f"{word()} 2024-{some(dig, 2)}-{some(dig, 2)}-{word()}-{word()}-{word()} {word()}", 0))
        line = f"{some(dig, 3)}{r.choice(' .-')}{some(dig, 4)}"
        call = r.choice(["call", "tel", "phone:", "Fax", "mobile", "dial"])
        out.append(("phone", f"{word()} {call} ({some(dig, 3)}) {line} {word()}", 1))
        out.append(("phone", f"{word()} {call} {some(dig, 3)}-{line} {word()}", 1))
        out.append(("phone", f"{word()} {r.choice(['rows', 'sum', 'pages', 'code', 'lot'])} {some(dig, 3)} {line} {word()}", 0))
        out.append(("phone", f"{word()} {word()} {some(dig, 3)}.{line} {word()}", 0))
        groups = [some(dig, 4) for _ in range(4)]
        grouped = lambda sizes, seps: "".join(some(dig, n) + (r.choice(seps) if k < len(sizes) - 1 else "") for k, n in enumerate(sizes))
        local = lambda: r.choice([grouped([2] * 5, [" ", ".", "-"]), grouped([3, 8], [" ", "/", "-"]), grouped([3, 7], "/ "), grouped([2, 3, 2, 2], " "), grouped([3] * 3, " -"), grouped([4, 3, 4], " "), grouped([3, 4], " -"), some(dig, r.randint(7, 12))])
        abroad = r.choice(["tel.", "Telefon", "Tel", "t\u00e9l\u00e9phone :", "appelez le", "llame al", "llame", "movil", "m\u00f3vil", "Handy", "Rufnummer", "portable", "phone", "call me at", "fax:", "mobile number"])
        for _ in range(2):
            out.append(("phone", f"{word()} {abroad} {r.choice(['', '0'])}{local()} {word()}", 1))
            out.append(("phone", f"{word()} {r.choice(['rows', 'total', 'ISBN', 'order', 'code', 'lot', word(), word()])} {local()} {word()}", 0))
        day = r.choice([f"{r.choice(['19', '20'])}{some(dig, 2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", f"{r.randint(10, 28)}.0{r.randint(1, 9)}.20{some(dig, 2)}"])
        out.append(("phone", f"{word()} {r.choice([abroad, 'called on', 'call'])} {day} {word()}", 0))
        out.append(("phone", f"{word()} {abroad} {r.choice(['order', 'invoice', 'code', 'serial', 'ref'])} {local()} {word()}", 0))
        out.append(("card", f"{word()} {r.choice(['card', 'visa', 'credit card no.', 'debit'])} {r.choice(' -').join(groups)} {word()}", 1))
        out.append(("card", f"{word()} {r.choice(['card:', 'Visa', 'payment'])} {''.join(groups)} {word()}", 1))
        out.append(("card", f"{word()} {r.choice(['isbn', 'order', 'serial', 'total', 'id'])} {some(dig, r.randint(13, 19))} {word()}", 0))
        out.append(("card", f"{word()} {some(dig, 4)} {some(dig, 4)} {some(dig, 4)} {some(dig, 3)} {word()}", 0))
        box = r.choice(["[]", "()", "<>"])
        at, dot = f"{box[0]}at{box[1]}", f"{box[0]}dot{box[1]}"
        out.append(("email", f"{word()} {word()} {at} {word()} {dot} com {word()}", 1))
        out.append(("email", f"{word()} {word()}.{word()}{at}{word()}.org {word()}", 1))
        end, mail = r.choice(["com", "org", "net", "de", "fr", "es"]), r.choice(["mail", "e-mail:", "contact", "correo", "courriel", "email me:"])
        out.append(("email", f"{word()} {word()} at {word()} {r.choice(['dot', 'punto', 'point'])} {end} {word()}", 1))
        out.append(("email", f"{word()} {mail} {word()} at {word()}.{end} {word()}", 1))
        out.append(("email", f"{word()} {word()}{r.choice([' @ ', ' @', '@ '])}{word()}.{end} {word()}", 1))
        out.append(("email", f"{word()} {word()} {box[0]} at {box[1]} {word()} {box[0]}dot{box[1]} {word()} {box[0]}dot{box[1]} {end} {word()}", 1))
        out.append(("email", f"{word()} {word()}{at} {word()}. {word()} {word()}", 0))
        out.append(("email", f"{word()} {word()}{at}{word()}.{word()}x {word()}", 0))
        out.append(("email", f"{word()} {word()} at {word()}. {r.choice([word(), 'It', 'Es', 'At', 'De'])} {word()}", 0))
        out.append(("email", f"{word()} {word()} at {word()}.{r.choice([end, word()])} {word()}", 0))
        out.append(("email", f"{word()} {r.choice([mail, word()])} {word()} at {r.choice(['the', 'a', 'this', 'each', 'every'])} {r.choice(['dot', 'point'])} {r.choice([word(), 'in', 'of', 'us', 'es'])} {word()}", 0))
        out.append(("email", f"{word()} {word()} at {word()} {r.choice(['dot', 'point'])} {word()}x {word()}", 0))
        six, host = lambda n: ":".join(r.choice("123456789abcdef") + some(hexa, r.randint(0, 3)) for _ in range(n)), r.choice(["ip", "IPv6", "address:", "host", "server", "ping", "from"])
        out.append(("ip", f"{word()} {word()} {six(8)} {word()}", 1))
        out.append(("ip", f"{word()} {word()} {r.choice(['2001:db8', 'fe80', 'fd12:3456', '2a02:26f0'])}::{six(r.randint(1, 4))} {word()}", 1))
        out.append(("ip", f"{word()} {host} {r.choice(['fe80::1', '2001:db8::', '::1', '2001:db8::' + six(2)])} {word()}", 1))
        out.append(("ip", f"{word()} {r.choice([host, word()])} {some(dig, 2)}:{some(dig, 2)}:{some(dig, 2)} {word()}", 0))
        out.append(("ip", f"{word()} {r.choice([host, word()])} {':'.join(some(hexa, 2) for _ in range(6))} {word()}", 0))
        out.append(("ip", f"{word()} {word()} {some(hexa, r.randint(1, 3))}::{some(hexa, r.randint(1, 3))} {word()}", 0))
        out.append(("ip", f"{word()} {r.choice([host, word()])} {six(2)}::{six(2)}::{six(1)} {word()}", 0))
        account = lambda: f"{r.choice(['DE', 'FR', 'ES', 'GB', 'NL'])}{{}}{some(dig, r.choice([14, 18, 20, 23]))}"
        four = lambda t: " ".join(t[k : k + 4] for k in range(0, len(t), 4))
        out.append(("iban", f"{word()} {r.choice([four, str])(checked(account()))} {word()}", 1))
        out.append(("iban", f"{word()} {r.choice([four, str])(checked(account(), r.randint(1, 96)))} {word()}", 0))
        number = f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
        out.append(("ssn", f"{word()} {r.choice(['SSN', 'ssn:', 'social security number', word(), word()])} {number} {word()}", 1))
        out.append(("ssn", f"{word()} {r.choice(['order', 'part no.', 'serial', 'ref:', 'item', 'model', 'ISBN', 'invoice'])} {number} {word()}", 0))
    r.shuffle(out)
    return out


def checked(pattern: str, off: int = 0) -> str:
    """An account number with its two check digits, wrong by ``off``."""
    digits_of = lambda t: int("".join(str(int(c, 36)) for c in t))
    right = 98 - digits_of(pattern[4:] + pattern[:2] + "00") % 97
    return pattern.format(f"{(right + off - 2) % 97 + 2:02d}")


def boost(rows: list[tuple[list[int], int]], rounds: int = 24, rate: float = 0.4) -> list[tuple]:
    """Depth-two trees (feature, cut, (feature, cut, low, high) below, the same above) by Newton steps on the logistic loss."""
    x, y = np.array([r[0] for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r[1] for r in rows], float)
    score, trees = np.zeros(len(rows)), []

    def best(idx: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
        found = (0.0, 0, 0.5)
        for f in range(len(FEATURES)):
            values, own = np.unique(x[idx, f], return_inverse=True)
            gl, hl = (np.cumsum(np.bincount(own, v[idx], len(values))) for v in (g, h))
            if len(values) < 2:
                continue
            gain = gl[:-1] ** 2 / (hl[:-1] + 1) + (gl[-1] - gl[:-1]) ** 2 / (hl[-1] - hl[:-1] + 1) - gl[-1] ** 2 / (hl[-1] + 1)
            k = int(gain.argmax())
            if gain[k] > found[0] + 1e-9:
                found = (float(gain[k]), f, float(values[k] + values[k + 1]) / 2)
        return found[1:]

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        f, cut = best(np.arange(len(rows)), g, h)
        sides = []
        for above in (False, True):
            idx = np.flatnonzero((x[:, f] >= cut) == above)
            f2, cut2 = best(idx, g, h) if len(idx) else (0, 0.5)
            low, high = idx[x[idx, f2] < cut2], idx[x[idx, f2] >= cut2]
            leaves = [float(-rate * g[part].sum() / (h[part].sum() + 1)) for part in (low, high)]
            score[low], score[high] = score[low] + leaves[0], score[high] + leaves[1]
            sides.append((f2, cut2, *leaves))
        trees.append((f, cut, *sides))
    return trees


def tree_score(trees: list[tuple], x) -> float:
    """Sum of the trees for a list of features."""
    return sum(side[2] if x[side[0]] < side[1] else side[3] for f, cut, low, high in trees for side in [low if x[f] < cut else high])


def tree_column(trees: list[tuple], x: Column) -> Column:
    """The same sum as an expression over an array of features; the trees are one constant array of nodes, so the plan stays small."""
    nodes = [dict(zip("fcalbuvgmh", (f, cut, *low, *high), strict=True)) for f, cut, low, high in trees]
    held = F.from_json(F.lit(json.dumps(nodes)), "array<struct<f:int,c:double,a:int,l:double,b:double,u:double,v:int,g:double,m:double,h:double>>")
    side = lambda t, f, cut, low, high: F.when(F.get(x, t[f]) < t[cut], t[low]).otherwise(t[high])
    one = lambda t: F.when(F.get(x, t["f"]) < t["c"], side(t, "a", "l", "b", "u")).otherwise(side(t, "v", "g", "m", "h"))
    return F.aggregate(held, F.lit(0.0), lambda acc, t: acc + one(t))


@lru_cache(maxsize=4)
def _model(spark: SparkSession) -> dict[str, tuple[list[tuple], float]]:
    """For each kind, trees fitted on two thirds of its examples and the threshold that the rest calibrates."""
    made = examples()
    every = F.from_json(F.lit(json.dumps([t for _, t, _ in made])), "array<string>")
    texts = spark.range(1).select(F.posexplode(every).alias("i", "t"))
    first = lambda k: let(F.get(located(F.col("t"), CANDIDATES[k]), F.lit(0)), lambda c: F.when(c.isNotNull(), features(k, c)))
    rows = texts.select("i", *(first(k).alias(k) for k in CANDIDATES)).collect()
    found = {}
    for kind in CANDIDATES:
        own = [(list(r[kind]), made[r.i][2]) for r in sorted(rows) if made[r.i][0] == kind and r[kind] is not None]
        trees = boost([x for k, x in enumerate(own) if k % 3], rounds=40)
        rest = [(tree_score(trees, x), y) for x, y in own[::3]]
        bad, good = [s for s, y in rest if not y], [s for s, y in rest if y]
        top = max(bad, default=-1.0)
        above = [s for s in good if s > top]
        found[kind] = (trees, (top + min(above)) / 2 if above else math.inf)
    return found


def added_spans(text: Column, base: Column, model: dict) -> Column:
    """Candidates that the trees select and that overlap no base span."""

    def chosen(kind: str) -> Column:
        trees, cut = model[kind]
        near = F.filter(located(text, CANDIDATES[kind]), lambda x: let(features(kind, x), lambda f: tree_column(trees, f) > cut))
        return F.coalesce(_named(kind, F.when(text.rlike(NEED_CANDIDATE[kind]), near)), F.array().cast("array<struct<k:int,s:int,e:int>>"))

    return let(F.array_distinct(F.concat(*(chosen(k) for k in model))), lambda near: apart(near, base))


def apart(near: Column, base: Column) -> Column:
    """The spans of ``near`` that overlap none of ``base``: of those that start before, the farthest end decides, of those after, the next start."""
    far = (1 << 31) - 1

    def sweep(every: Column) -> Column:
        ends = running(F.transform(every, lambda x: F.when(x["base"], x["e"]).otherwise(-1)), F.greatest, -1)
        starts = F.reverse(running(F.reverse(F.transform(every, lambda x: F.when(x["base"], x["s"]).otherwise(far))), F.least, far))
        free = lambda e, n: F.filter(every, lambda x, i: ~x["base"] & (F.get(e, i) <= x["s"]) & (F.get(n, i) >= x["e"]))
        return let(ends, lambda e: let(starts, lambda n: F.transform(free(e, n), lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))))

    marked = lambda v, flag: F.transform(v, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), F.lit(flag).alias("base")))
    both = F.array_sort(F.concat(marked(base, True), marked(near, False)))
    return F.when((F.size(near) == 0) | (F.size(base) == 0), near).otherwise(let(both, sweep))


def spans(text: Column, spark: SparkSession) -> Column:
    """Struct of base and all spans; each an ordered array of (kind index, start, end)."""
    plain, model = F.coalesce(text, F.lit("")), _model(spark)
    base = F.concat(*(base_spans(plain, k) for k in BASE))
    more = lambda b: added_spans(plain, b, model)
    return let(base, lambda b: F.struct(b.alias("base"), F.array_sort(F.concat(b, more(b))).alias("all")))


@lru_cache(maxsize=64)
def _spans_of(text_col: str, spark: SparkSession) -> Column:
    """The expression for a column; building it takes seconds, so it is built once a session."""
    return spans(F.col(text_col), spark)


@lru_cache(maxsize=64)
def _redacted_of(text_col: str, spark: SparkSession) -> Column:
    return redacted(F.col("_doc")[text_col], F.col("_all"))


def listed(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, and n_spans, the number of all spans."""
    held = docs.select(F.col(id_col).alias("doc_id"), _spans_of(text_col, docs.sparkSession).alias("_s"))
    count = lambda i: F.size(F.filter(F.col("_s.base"), lambda x: x["k"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return held.select("doc_id", *counts, F.sha2(listed(F.col("_s.base")), 256).alias("base_sha256"), listed(F.col("_s.all")).alias("spans"), F.size("_s.all").cast("long").alias("n_spans"))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.array_sort(F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def cut(blocks: Column, size: Column) -> Column:
        """Pieces of the text and names in turn; a piece is taken from the blocks it touches, as finding a place reads all before it."""

        def piece(a: Column, b: Column) -> Column:
            part = lambda k: let(F.greatest(a - k * size, F.lit(0)), lambda y: F.substring(F.get(blocks, k), y + 1, F.least(b - k * size, size) - y))
            return F.when(a < b, F.array_join(F.transform(F.sequence(F.floor(a / size).cast("int"), F.floor((b - 1) / size).cast("int")), part), "")).otherwise("")

        def pieces(x: Column, ends: Column) -> Column:
            before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
            each = F.transform(x, lambda y, i: F.when(y["s"] >= before(i), F.concat(piece(before(i), y["s"]), F.get(names, y["k"]))).otherwise(""))
            return F.concat(F.array_join(each, ""), piece(F.element_at(ends, -1), F.length(text)))

        return let(by_start, lambda x: let(running(F.transform(x, lambda y: y["e"]), F.greatest, 0), lambda ends: pieces(x, ends)))

    size = (16 * F.ceil(F.sqrt(F.length(text).cast("double")))).cast("int")
    blocks = lambda z: F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / z).cast("int")), lambda i: F.substring(text, i * z + 1, z))
    return F.when(F.size(found) == 0, text).otherwise(let(size, lambda z: let(blocks(z), lambda held: cut(held, z))))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced; n_chars, where there is one, follows the text."""
    held = docs.select(row_of(docs).alias("_doc"), _spans_of(text_col, docs.sparkSession)["all"].alias("_all"))
    held = held.select("_doc", _redacted_of(text_col, docs.sparkSession).alias("_new"))
    out = []
    for c in docs.columns:
        own = F.col("_doc")[c]
        if c == text_col:
            own = F.col("_new")
        elif c == "n_chars":
            own = F.when(F.col("_new") != F.col("_doc")[text_col], F.length("_new").cast(docs.schema[c].dataType)).otherwise(own)
        out.append(own.alias(c))
    return held.select(*out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
