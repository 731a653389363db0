"""Generated labelled texts for the span model: formats that no base pattern covers, and look-alikes that are no personal data.

A bounded number (``GENERATED``) drawn with a fixed seed, so the model doesn't
depend on how often a corpus happens to hold each kind.
"""

from __future__ import annotations

import random
import string

#: Generated texts the model is fitted on; half of them hold a span.
GENERATED = 360

_SECRET = ["api_key={}", "export API_KEY={}", 'token = "{}"', "password: {}", "the password is {} for now", "secret={};", "Authorization: Bearer {}", "auth token {} expires soon", "passwd={}", '"client_secret": "{}"', "credentials: user bob / {}"]
_KEYED = ["use {} to log in", "aws_access_key_id = {}", "found {} in the log"]
_PHONE = ["tel {}", "Tel. {}", "phone: {}", "call {} now", "mobile {} or mail", "fax {}", "Telefon: {} (mornings)", "contact by phone {}"]
_IBAN = ["IBAN {}", "account {}", "transfer to {} today", "Konto: {}", "pay {} at once"]
_HASHES = ["commit {} merged", "sha256 {}", "md5 = {}", "checksum: {} ok", "revision {}", "{} is the digest", "build {} passed", "see {} there", "hash={}", "object {}"]
_NUMBERS = ["order {} came", "invoice {}", "item {} in stock", "tracking {}", "part number {}", "on {} we met", "total {} units", "row {} of it", "version {}", "from {} on", "population {} people", "id={}"]


def iban(rng: random.Random, valid: bool = True) -> str:
    country, size = rng.choice([("DE", 18), ("ES", 20), ("FR", 23), ("NL", 14), ("CZ", 20)])
    rest = "".join(rng.choice(string.digits) for _ in range(size))
    check = 98 - int(rest + "".join(str(ord(c) - 55) for c in country) + "00") % 97
    code = f"{country}{(check if valid else check % 90 + 7):02d}{rest}"
    return " ".join(code[k : k + 4] for k in range(0, len(code), 4)) if rng.random() < 0.5 else code


def secret(rng: random.Random) -> str:
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    kind = rng.randrange(4)
    if kind == 0:
        return pick("0123456789abcdef", rng.choice([32, 40, 64]))
    if kind == 1:
        return "A7" + pick(string.ascii_letters + string.digits, rng.randrange(18, 38)) + "q"
    if kind == 2:
        return rng.choice(["hunter", "Sommer", "dragon", "secreto", "blue"]) + pick(string.digits, rng.randrange(1, 5)) + rng.choice("!_-") + pick(string.ascii_letters, 3)
    return pick(string.ascii_letters, 5) + pick(string.digits, 2) + pick(string.ascii_letters + string.digits, 6) + "x"


def access_key(rng: random.Random) -> str:
    return rng.choice(["AKIA", "ghp_"]) + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(14)) + "9K"


def phone(rng: random.Random) -> str:
    d = lambda n: str(rng.randrange(10 ** (n - 1), 10**n))
    return rng.choice([f"0049 {d(2)} {d(7)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(2)} {d(7)}", f"01{d(2)} {d(8)}", f"06 {d(2)} {d(2)} {d(2)} {d(2)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(3)}/{d(6)}"])


def digest(rng: random.Random) -> str:
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    return rng.choice([h(40), h(64), h(32), f"{h(8)}-{h(4)}-4{h(3)}-a{h(3)}-{h(12)}", h(40), h(28)])


def number(rng: random.Random) -> str:
    d = lambda n: str(rng.randrange(10 ** (n - 1), 10**n))
    return rng.choice([d(3), d(5), d(10), d(12), f"{d(3)}-{d(4)}", f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}.{d(2)}.{d(1)}", f"{d(3)} {d(3)} {d(3)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(2)},{d(3)}", f"A{d(4)}", f"{d(4)} to {d(4)}", f"x{d(2)}y{d(3)}", iban(rng, valid=False)])


def examples(n: int = GENERATED, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, [(kind, start, end)]); places are code points."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        kind, templates, make = [
            ("secret", _SECRET, secret),
            (None, _HASHES, digest),
            ("phone", _PHONE, phone),
            (None, _NUMBERS, number),
            ("iban", _IBAN, iban),
            (None, _HASHES, digest),
            ("secret", *((_KEYED, access_key) if k % 16 < 8 else (_SECRET, secret))),
            (None, _NUMBERS, number),
        ][k % 8]
        before, after = rng.choice(templates).split("{}")
        value = make(rng)
        out.append((before + value + after, [(kind, len(before), len(before) + len(value))] if kind else []))
    return out
