"""Labelled findings of several kinds, made by rule: what the secret scan's forest learns from.

The label of a finding is its kind, which the forest never sees: an access key is a secret whatever its name, a commit
hash is none even where it is called a key. Values and what stands around them are drawn apart from each other, with
names that both labels share, so that no single test tells them.
"""

from __future__ import annotations

import base64
import random
import string
import uuid
from collections.abc import Callable

HEX, ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
WORDS = (
    "river stone garden window orange purple winter monkey dragon silver copper falcon thunder meadow castle hunter"
    " pepper ginger summer forest rocket shadow planet harbor candle marble velvet walnut saddle lantern"
).split()

Value = Callable[[random.Random], str]


def _hex(*sizes: int) -> Value:
    return lambda r: _cased(r, "".join(r.choices(HEX, k=r.choice(sizes))))


def _cased(r: random.Random, text: str) -> str:
    return text.upper() if r.random() < 0.2 else text


def _mixed(low: int, high: int, letters: str = ALNUM) -> Value:
    return lambda r: "".join(r.choices(letters, k=r.randint(low, high)))


def _prefixed(r: random.Random) -> str:
    prefix = r.choice(["sk_live_", "pk_test_", "AKIA", "ghp_", "xox-", "rk-", "npm_", "glpat-"])
    return prefix + "".join(r.choices(ALNUM, k=r.randint(16, 40)))


def _encoded(r: random.Random) -> str:
    return base64.b64encode(r.randbytes(r.randint(15, 48))).decode()


def _password(r: random.Random) -> str:
    return "".join(r.choices(ALNUM + "!#$%&*+?@^_-", k=r.randint(8, 20)))


def _passphrase(r: random.Random) -> str:
    """Without a digit: words run together, some with capitals or signs."""
    words = [w.capitalize() if r.random() < 0.4 else w for w in r.sample(WORDS, r.randint(2, 4))]
    return r.choice(["", "-", "_", "!"]).join(words)


def _path(r: random.Random) -> str:
    parts = [r.choice(WORDS) + r.choice(["", "", str(r.randint(1, 99))]) for _ in range(r.randint(3, 6))]
    return "/" + "/".join(parts)


def _identifier(r: random.Random) -> str:
    parts = [*r.sample(WORDS, r.randint(2, 4)), str(r.randint(1, 2025))]
    return "_".join(parts) if r.random() < 0.6 else "".join(p.capitalize() for p in parts)


def _placeholder(r: random.Random) -> str:
    return r.choice(["your_api_key_here_1", "xxxxxxxxxxxxxxxx0", "changeme", "REPLACE_ME_WITH_KEY_1", "example-token-0000", "<password>", "insert-your-password", "0000000000000000", "aaaaaaaaaaaaaaaa1"])


def _release(r: random.Random) -> str:
    return f"{r.choice(WORDS)}-{r.randint(0, 9)}-{r.randint(0, 30)}-{r.randint(0, 30)}-{r.choice(WORDS)}"


#: Kind → label, value, and names it may stand behind.
_SECRET_NAMES = ["token", "api_key", "secret", "password", "key", "access_token", "client_secret", "auth", "credentials"]
_PLAIN_NAMES = ["commit", "checksum", "digest", "id", "path", "file", "order", "version", "ref", "sha1", "md5", "key", "name"]
KINDS: dict[str, tuple[bool, Value, list[str]]] = {
    "hex key": (True, _hex(32, 40, 64), _SECRET_NAMES),
    "mixed key": (True, _mixed(20, 48), _SECRET_NAMES),
    "prefixed key": (True, _prefixed, _SECRET_NAMES + ["id", "name", "ref"]),
    "encoded key": (True, _encoded, _SECRET_NAMES),
    "password": (True, _password, ["password", "passwd", "pwd", "secret", "credentials"]),
    "passphrase": (True, _passphrase, ["password", "passwd", "pwd", "secret"]),
    "hash": (False, _hex(32, 40, 64), _PLAIN_NAMES),
    "uuid": (False, lambda r: str(uuid.UUID(int=r.getrandbits(128))), _PLAIN_NAMES + ["token"]),
    "number": (False, lambda r: "".join(r.choices(string.digits, k=r.randint(16, 24))), _PLAIN_NAMES + ["card", "account"]),
    "path": (False, _path, _PLAIN_NAMES + ["secret", "token"]),
    "identifier": (False, _identifier, _PLAIN_NAMES + ["token", "auth"]),
    "placeholder": (False, _placeholder, _SECRET_NAMES),
    "release": (False, _release, _PLAIN_NAMES),
}


def labelled_findings(n: int, seed: int = 12) -> list[tuple[str, str, str, bool, str]]:
    """`n` findings: candidate, text before, text after, whether it is a secret, kind; all kinds alike often."""
    r = random.Random(seed)
    out = []
    kinds = list(KINDS.items())
    for i in range(n):
        kind, (secret, value, names) = kinds[i % len(kinds)]
        name = r.choice(names)
        before, after = r.choice(
            [
                (f'{name} = "', '"'),
                (f"{name}: ", r.choice(["", " ", ","])),
                (f"{name}=", r.choice([" ", "&", ";"])),
                (f'"{name}": "', '",'),
                (f"{name} is ", r.choice([".", " "])),
                (f"export {name.upper()}='", "'"),
            ]
            if secret or r.random() < 0.6
            else [
                (" ".join(r.sample(WORDS, 3)) + " ", " " + r.choice(WORDS)),
                (f"see https://{r.choice(WORDS)}.example/", " "),
                ("(", ")"),
            ]
        )
        out.append((value(r), r.choice(["", " ".join(r.sample(WORDS, 2)) + " "]) + before, after, secret, kind))
    return out
