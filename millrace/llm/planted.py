"""Secrets and look-alikes to plant in texts, so that a tagger learns shapes that no fixed pattern has."""

from __future__ import annotations

import base64
import random
import string
import uuid

ALNUM = string.ascii_letters + string.digits
UPPER = string.ascii_uppercase + string.digits


def _of(r: random.Random, alphabet: str, low: int, high: int) -> str:
    """A random word with a digit and a letter in it."""
    n = r.randint(low, high)
    out = [r.choice(alphabet) for _ in range(n - 2)] + [r.choice("0123456789"), r.choice([c for c in alphabet if c.isalpha()])]
    r.shuffle(out)
    return "".join(out)


def _jwt(r: random.Random) -> str:
    part = lambda n: base64.urlsafe_b64encode(r.randbytes(n)).decode().rstrip("=")
    return f"eyJ{part(24)}.eyJ{part(45)}.{part(32)}"


def _pass(r: random.Random) -> str:
    word = "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4)))
    return r.choice([word, word.capitalize()]) + str(r.randint(10, 9999)) + r.choice(["", "!", "#", "$"])


#: (words before the secret, the secret's words) by shape.
SHAPES = {
    "bare_password": lambda r: ([r.choice(["password", "passwd", "Password"])], [_pass(r)]),
    "pwd": lambda r: ([r.choice(["pwd", "PWD:", "pwd:"])], [_pass(r)]),
    "password_is": lambda r: ([r.choice(["password", "secret", "token"]), "is"], [_pass(r) if r.random() < 0.5 else _of(r, ALNUM, 10, 24)]),
    "bearer": lambda r: ([r.choice(["Bearer", "bearer"])], [_jwt(r) if r.random() < 0.5 else _of(r, ALNUM, 20, 48)]),
    "jwt": lambda r: ([], [_jwt(r)]),
    "github_like": lambda r: (r.choice([[], ["token"], ["TOKEN"]]), [r.choice(["ghp_", "gho_", "github_pat_"]) + _of(r, ALNUM, 30, 40)]),
    "payment_like": lambda r: (r.choice([[], ["key"]]), [r.choice(["sk_live_", "rk_test_", "pk_live_"]) + _of(r, ALNUM, 20, 32)]),
    "chat_like": lambda r: (r.choice([[], ["token"]]), [r.choice(["xoxb-", "xoxp-"]) + f"{r.randint(10**9, 10**11)}-{_of(r, ALNUM, 20, 28)}"]),
    "search_like": lambda r: (r.choice([[], ["key"]]), ["AIza" + _of(r, ALNUM + "_-", 30, 38)]),
    "basic": lambda r: (["Authorization:", "Basic"], [base64.b64encode(r.randbytes(r.randint(18, 36))).decode()]),
    "upper_hex": lambda r: (r.choice([[], ["key"], ["auth"]]), [_of(r, "0123456789ABCDEF", 32, 40)]),
    "base64_key": lambda r: (r.choice([[], ["secret"], ["credential"]]), [base64.b64encode(r.randbytes(r.randint(24, 48))).decode()]),
    "key_uuid": lambda r: ([r.choice(["apikey", "key", "auth"])], [str(uuid.UUID(int=r.getrandbits(128)))]),
    "long_alnum": lambda r: ([], [_of(r, ALNUM, 32, 64)]),
    "short_id": lambda r: (["access", "key"], [_of(r, UPPER, 16, 20)]),
}

#: What looks like a secret and is none.
ALIKE = (
    lambda r: [f"{_word(r)}.{r.randint(1, 99)}@{_word(r)}{r.randint(1, 9)}.{r.choice(['com', 'org', 'example.com'])}"],
    lambda r: [f"{r.choice(['http', 'https'])}://{_word(r)}.{r.choice(['org', 'com'])}/{_word(r)}/{r.randint(1, 9999)}?{_word(r)}={r.randint(1, 99)}"],
    lambda r: [f"+{r.randint(1, 99)}-{r.randint(100, 999)}-{r.randint(1000, 9999)}"],
    lambda r: [f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2030)}"],
    lambda r: [f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}:{r.randint(0, 59):02}:00Z"],
    lambda r: [str(r.randint(10**3, 10**15))],
    lambda r: [f"v{r.randint(0, 20)}.{r.randint(0, 40)}.{r.randint(0, 9)}"],
    lambda r: [f"{_word(r)}_{_word(r)}{r.randint(1, 9)}.{r.choice(['py', 'txt', 'html', 'jpg'])}"],
    lambda r: [f"{_word(r).upper()}-{r.randint(1, 9999)}"],
    lambda r: ["".join(_word(r) for _ in range(5))],
    lambda r: [r.choice(["password", "secret", "token", "key", "auth", "credential", "bearer"]), _word(r)],
    lambda r: ["the", r.choice(["password", "secret", "token", "key"]), "is", _word(r)],
    lambda r: [f"{_word(r)}{r.choice('!?,;:')}{r.choice('!?,;:*#$')}", _word(r).upper() + "!!"],
)


def _word(r: random.Random) -> str:
    return "".join(r.choice("bcdfghlmnprst") + r.choice("aeiouäéè") for _ in range(r.randint(1, 4)))


def with_secret(r: random.Random, shape: str | None = None) -> tuple[list[str], int]:
    """(words, how many of the last are the secret)."""
    before, secret = SHAPES[shape or r.choice(list(SHAPES))](r)
    quote = r.choice(["", "", "", '"', "'", "`"])
    return [*before, *(quote + s + quote + r.choice(["", "", ".", ","]) for s in secret)], len(secret)


def alike(r: random.Random) -> list[str]:
    return r.choice(ALIKE)(r)
