"""Planted spans for the PII trees: private values of each kind in usual formats, and look-alikes, each with
words that usually stand before and after them.

``half`` chooses between two disjoint sets of such words, so that what the trees are calibrated on stands
in words that they have not seen.
"""

from __future__ import annotations

import base64
import json
from random import Random

_HEX = "0123456789abcdef"
_SMALL = "abcdefghijklmnopqrstuvwxyz"
_MIXED = _SMALL + _SMALL.upper() + "0123456789"
_SYLLABLES = ("ba be bo ca co da de di do fa fe ga ha jo ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa "
              "se si so ta te ti to va ve vi wa we").split()

# Words before (fixed values): the first list is learnt from, the second calibrated on.
_BEFORE = {
    "email": (["", "mail ", "contact: ", "write to "], ["", "e-mail: ", "reach me: ", "send it to "]),
    "ip": (["", "from ", "host ", "ip: "], ["", "server ", "address ", "ping "]),
    "card": (["", "card ", "visa: ", "paid with "], ["", "credit card ", "card no: ", "charge "]),
    "phone": (["", "call ", "tel: ", "phone "], ["", "mobile ", "fax: ", "phone no. "]),
}
_NAMES = (["password", "token", "api_key"], ["passwd", "secret", "api-key"])
_SIGNS = ["=", ": ", " = ", "=\"", ":"]
#: What stands for a secret where none is told.
PLACEHOLDERS = ("required undefined changeme incorrect expired missing invalid unknown optional default example string "
                "hidden redacted null none empty password secret token yourpassword your_password").split()
_EMPTY = [*(w for w in PLACEHOLDERS if len(w) >= 6), "<password>", "{token}", "${SECRET}", "********", "<your-key>", "[hidden]", "%TOKEN%"]


def _pick(rng: Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


def _word(rng: Random, most: int = 4) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(2, most)))


def _digits(rng: Random, n: int) -> str:
    return _pick(rng, "0123456789", n)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def card_number(rng: Random, valid: bool = True) -> str:
    start = rng.choice(["4", "51", "55", "6011", "34", "37"])
    n = 15 if start in ("34", "37") else 16
    body = start + _digits(rng, n - 1 - len(start))
    last = next(str(c) for c in range(10) if _luhn(body + str(c)) == 0)
    return body + (last if valid else str((int(last) + rng.randint(1, 9)) % 10))


def _grouped(number: str, sign: str) -> str:
    cuts = (4, 10) if len(number) == 15 else (4, 8, 12)
    return sign.join(number[a:b] for a, b in zip((0, *cuts), (*cuts, len(number))))


def _domain(rng: Random) -> str:
    return f"{_word(rng)}.{rng.choice(['com', 'org', 'net', 'de', 'co.uk', 'example.com'])}"


def _local(rng: Random) -> str:
    return rng.choice([_word(rng), f"{_word(rng)}.{_word(rng)}", f"{_word(rng)}{rng.randrange(100)}", f"{_word(rng)}_{_word(rng)}"])


def _email(rng: Random) -> str:
    a, b = rng.choice([(" [at] ", " [dot] "), ("[at]", "."), ("(at)", "."), (" at ", " dot "), (" (at) ", " (dot) "),
                       ("[at]", "[dot]"), (" AT ", " DOT ")])
    return _local(rng) + a + _domain(rng).replace(".", b)


def _ipv6(rng: Random) -> str:
    def part() -> str:
        return f"{rng.randrange(1, 65536):x}"

    head = rng.choice(["2001:db8", "2a02:" + part(), "fe80", "2606:4700", "fd" + _pick(rng, _HEX, 2) + ":" + part()])
    fill = 8 - head.count(":") - 1
    if rng.random() < 0.4:
        return ":".join([head, *(part() for _ in range(fill))])
    return head + "::" + ":".join(part() for _ in range(rng.randint(1, min(4, fill - 1))))


def _phone(rng: Random) -> str:
    area, mid, last = f"{rng.randrange(201, 990)}", f"{rng.randrange(200, 999)}", _digits(rng, 4)
    return rng.choice([f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"{area} {mid} {last}",
                       f"1-{area}-{mid}-{last}", f"(0{area}) {mid} {last}"])


def _jwt(rng: Random) -> str:
    def part(value) -> str:
        return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")

    return ".".join([part({"alg": "HS256", "typ": "JWT"}), part({"sub": _digits(rng, 8), "name": _word(rng), "iat": rng.randrange(10**9)}),
                     _pick(rng, _MIXED + "_-", 43)])


def _password(rng: Random) -> str:
    return rng.choice([_word(rng) + _digits(rng, 3) + rng.choice("!#$%"), _word(rng, 5) + _word(rng, 5),
                       _pick(rng, _MIXED, rng.randint(8, 20)), _word(rng) + "-" + _word(rng) + "-" + _word(rng)])


def _secret(rng: Random, half: int) -> tuple[str, str, str]:
    key = rng.choice(_NAMES[half]) + rng.choice(_SIGNS)
    close = '"' if key.endswith('"') else ""
    which = rng.randrange(7)
    if which == 0:
        return key, _password(rng), close
    if which == 1:
        return key, _pick(rng, _HEX, rng.choice([18, 24, 32, 40, 64])), close
    if which == 2:
        return rng.choice(["", key]), "AKIA" + _pick(rng, _SMALL.upper() + "234567", 16), ""
    if which == 3:
        return ["Bearer ", "Authorization: Bearer "][half], _jwt(rng), ""
    if which == 4:
        user, scheme = _word(rng), rng.choice(["https", "postgres", "ftp", "amqp"])
        return f"{scheme}://{user}:", rng.choice([_password(rng).replace("/", ""), _pick(rng, _MIXED, 12)]), f"@{_domain(rng)}/x"
    if which == 5:
        return key, rng.choice(["ghp_", "sk_live_", "xoxb-"]) + _pick(rng, _MIXED, rng.randint(20, 40)), close
    return key, _pick(rng, _MIXED + "+/", rng.choice([24, 32, 44])), close


def private(kind: str, rng: Random, half: int) -> tuple[str, str, str]:
    """Words before, a private value that the base rules do not find, and what follows it."""
    if kind == "secret":
        return _secret(rng, half)
    span = {"email": _email, "ip": _ipv6, "phone": _phone,
            "card": lambda r: _grouped(card_number(r), ".")}[kind](rng)
    return rng.choice(_BEFORE[kind][half]), span, rng.choice(["", ",", ".", ")"])


def look_alike(kind: str, rng: Random, half: int) -> tuple[str, str, str]:
    """Words before, something that resembles a private value, and what follows it."""
    version = ".".join(str(rng.randrange(30)) for _ in range(rng.choice([3, 5, 6])))
    date = f"{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"
    clock = f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}"
    uuid = "-".join(_pick(rng, _HEX, n) for n in (8, 4, 4, 4, 12))
    if kind == "email":
        return rng.choice([
            ("look ", f"at {_word(rng)}", ""), ("", f"@{_word(rng)}", ""), ("meet ", f"{_word(rng)} at {_word(rng)}", ""),
            ("", f"{_word(rng)}@{_word(rng)}", ""), ("price ", f"{rng.randrange(9)}@{rng.randrange(99)}", ""),
            ("join ", f"us at {_word(rng)} dot", ""), ("git ", f"{_word(rng)}@{_word(rng)}:{_word(rng)}", "")])
    if kind == "ip":
        return rng.choice([
            (["version ", "release "][half], version, ""), (["at ", "since "][half], clock, ""), ("", f"std::{_word(rng)}", "<int>"),
            ("", f"{_word(rng)}::{_word(rng)}", "()"), (["mac ", "wlan "][half], ":".join(_pick(rng, _HEX, 2) for _ in range(6)), ""),
            ("ratio ", f"{rng.randrange(1, 99)}:{rng.randrange(1, 99)}:{rng.randrange(1, 99)}", ""),
            ("", f"{date}T{clock}:{rng.randrange(100):02d}", ""), (["chapter ", "section "][half], version, ""),
            ("", ".".join(str(rng.randrange(256, 900)) for _ in range(4)), "")])
    if kind == "card":
        return rng.choice([
            (["order ", "invoice "][half], _digits(rng, rng.choice([13, 16, 18])), ""),
            ("", _grouped(card_number(rng, False), rng.choice(".- ")), ""), (["isbn ", "serial "][half], f"978-{_digits(rng, 1)}-{_digits(rng, 4)}-{_digits(rng, 4)}-{_digits(rng, 1)}", ""),
            ("", f"{rng.randrange(1000, 9999)}.{_digits(rng, 4)}.{_digits(rng, 4)}", ""), ("", " ".join(_digits(rng, rng.randint(1, 5)) for _ in range(6)), ""),
            ("", f"{date} {clock}".replace(":", "-"), ""), (["id ", "no "][half], uuid, "")])
    if kind == "phone":
        return rng.choice([
            (["date ", "since "][half], date, ""), (["order ", "invoice "][half], f"{_digits(rng, 3)}-{_digits(rng, 7)}-{_digits(rng, 7)}", ""),
            ("", " ".join(_digits(rng, rng.randint(1, 6)) for _ in range(rng.randint(3, 6))), ""), (["isbn ", "serial "][half], f"{_digits(rng, 1)}-{_digits(rng, 5)}-{_digits(rng, 3)}-{_digits(rng, 1)}", ""),
            ("", f"{date} - {rng.randrange(1990, 2030)}", ""), (["version ", "build "][half], ".".join(_digits(rng, rng.randint(1, 5)) for _ in range(4)), ""),
            ("", _digits(rng, rng.randint(8, 14)), ""), ("lines ", f"{rng.randrange(9999)}-{rng.randrange(9999)} of {rng.randrange(99999)}", "")])
    key = rng.choice(_NAMES[half]) + rng.choice(_SIGNS[:3])
    return rng.choice([
        (key, rng.choice(_EMPTY), ""), (["commit ", "rev "][half], _pick(rng, _HEX, 40), ""), (["md5 ", "sha256: "][half], _pick(rng, _HEX, rng.choice([32, 64])), ""),
        (["id ", "uuid "][half], uuid, ""), ("https://" + _domain(rng) + "/", f"{_word(rng)}-{_word(rng)}-{_word(rng)}-{rng.randrange(99999)}", "/"),
        ("", f"{_word(rng)}_{_word(rng)}_{_word(rng)}_{rng.randrange(99)}", "("), ("", f"{_word(rng)}/{_word(rng)}/{_word(rng)}{rng.randrange(9)}/{_word(rng)}", ""),
        ("", "=" * rng.randint(16, 40) + str(rng.randrange(10)), ""), (["etag ", "digest "][half], _pick(rng, _MIXED, 27) + "=", ""),
        ("", f"{_word(rng, 5)}{_word(rng, 5)}{_word(rng, 5)}{rng.randrange(99)}", "")])
