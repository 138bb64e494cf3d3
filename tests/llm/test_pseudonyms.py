"""Pseudonyms against the same Feistel rounds in plain Python."""

import datetime
import hashlib
import random
import re

from scorewatch.llm import pii

KEY = "a key"


def feistel(left, left_bases, right, right_bases, tweak):
    for i in range(1, pii.ROUNDS + 1):
        turned = []
        for j, (x, base) in enumerate(zip(left, left_bases)):
            seed = f"{KEY}|{tweak}|{i}|{','.join(map(str, right))}|{j // 32}"
            shift = int(hashlib.sha512(seed.encode()).hexdigest()[4 * (j % 32):4 * (j % 32) + 4], 16)
            turned.append((x + shift) % base)
        left, left_bases, right, right_bases = right, right_bases, turned, left_bases
    return left + right


ALPHABETS = {"d": "0123456789", "h": "0123456789abcdef", "l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def masked(value, mask, kind):
    places = [i for i, m in enumerate(mask) if m != "."]
    codes = [ALPHABETS[mask[i]].index(value[i]) for i in places]
    bases = [len(ALPHABETS[mask[i]]) for i in places]
    half = len(places) // 2
    new = feistel(codes[:half], bases[:half], codes[half:], bases[half:], f"{kind}{len(value)}")
    out = list(value)
    for i, code in zip(places, new):
        out[i] = ALPHABETS[mask[i]][code]
    return "".join(out)


def plain(value):
    return "".join("d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "." for c in value)


def number(value):
    while True:
        value = masked(value, plain(value), "ssn")
        if re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", value):
            return value


def address(value):
    octets = [int(x) for x in value.split(".")]
    return ".".join(map(str, feistel(octets[:2], [256] * 2, octets[2:], [256] * 2, "ip")))


def date(value, form):
    first, (a, b) = datetime.date(1800, 1, 1), pii.DAYS
    n = (datetime.datetime.strptime(value, form).date() - first).days
    left, right = feistel([n // b], [a], [n % b], [b], "date")
    day = first + datetime.timedelta(days=left * b + right)
    return day.strftime(form) if day.year >= 1000 else value


def mail(value):
    local, domain = value.split("@")
    return masked(value, plain(local) + "." * (len(domain) + 1), "email")


def secret(value):
    if len(value) <= pii.TOGETHER:
        return masked(value, plain(value), "secret")
    parts = [value[i:i + pii.STRETCH] for i in range(0, len(value), pii.STRETCH)]
    return "".join(masked(p, plain(p), "secret") for p in parts)


def test_pseudonyms_are_the_feistel_rounds(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    made = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    rows, wanted = [], []
    for i in range(60):
        day = datetime.date(1900, 1, 1) + datetime.timedelta(days=rng.randint(0, 50_000))
        values = [
            ("see ", made("0123456789abcdef", rng.choice([32, 40, 64])), lambda v: masked(v, "h" * len(v), "hex")),
            ("mail ", f"{made('abcdefgh', 5)}.{made('XYZ12', 4)}@example.org", mail),
            ("host ", ".".join(str(rng.randint(0, 255)) for _ in range(4)), address),
            ("on ", day.strftime("%Y-%m-%d"), lambda v: date(v, "%Y-%m-%d")),
            ("on ", day.strftime("%d.%m.%Y"), lambda v: date(v, "%d.%m.%Y")),
            ("no ", f"{rng.randint(100, 600):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}", number),
            ("token=", "x" + made(letters, rng.choice([9, 40, 120, 127, 128, 300])), secret),
        ]
        rows.append((i, "; ".join(a + v for a, v, _ in values)))
        wanted.append((i, "; ".join(a + f(v) for a, v, f in values)))
    found = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == wanted
