"""The base patterns by brute force, and secrets behind layers of encoding."""

import base64
import gzip
import random
import re
import urllib.parse
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from brisa.llm import secrets

SECRET = "password = 'hunter2hunter2hunter2'"


def base(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ["assign", "access", "hex"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


PARTS = st.sampled_from(["password", "PASSWD", "Secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "ſecret", "é", "\n", "K"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans(text):
    found, spans, complete = secrets.scan_text(text)
    assert found == base(text) and set(found) <= set(spans) and complete


def test_layers_map_to_their_place():
    for wrap in (
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
        lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
        lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
        lambda s: base64.b64encode(gzip.compress(base64.b64encode(s.encode()))).decode(),
        lambda s: urllib.parse.quote(base64.b64encode(s.encode()).decode(), safe=""),
        lambda s: "".join(f"%{b:02X}" for b in s.encode()),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"&#{ord(c)};" for c in s),
        lambda s: s.encode().hex(),
    ):
        packed = wrap(SECRET)
        text = f"Ünder the é {packed} of"
        spans = secrets.scan_text(text)[1]
        start, end = text.index(packed), text.index(packed) + len(packed)
        assert any(k == "assign" and s >= start and e <= end for k, s, e in spans), packed
        assert "hunter2" not in str(secrets.scan_text(secrets.redacted(text, spans)))
        assert secrets.redacted(text, spans).startswith("Ünder the é ") and secrets.redacted(text, spans).endswith(" of")


def test_escapes_inside_a_secret_keep_its_ends():
    text = "x pass%77ord%3D%27abcdefghijkl1 y"
    assert ("assign", 2, text.index(" y")) in secrets.scan_text(text)[1]


def test_prose_and_loops_end():
    assert secrets.scan_text("Inthininganeaothonthatthereand " * 50)[1] == []
    text = "a"
    for _ in range(12):
        text = base64.b64encode(text.encode()).decode()
    assert secrets.scan_text(text)[2]
    assert secrets.scan_text("%25" * 40 + "41")[2]


def test_bombs_are_reported():
    bomb = base64.b64encode(zlib.compress(b"a" * 5_000_000)).decode()
    assert secrets.scan_text(bomb, most=100_000)[2] is False


def test_redaction_joins_overlaps():
    assert secrets.redacted("abcdefgh", [("hex", 1, 4), ("assign", 3, 6)]) == "a[SECRET]gh"
    assert secrets.redacted("abc", []) == "abc" and secrets.redacted("abc", [("hex", 0, 3)]) == "[SECRET]"


def kinds(text):
    found = secrets.scan_text(text)
    assert found[2]
    return {kind for kind, _, _ in found[1]}


def test_no_layer_is_left_out_for_the_size_of_others():
    """Layers after a bomb, the part of a bomb that is unpacked late, and what is encoded within it."""
    bomb = base64.b64encode(zlib.compress(b"a " * (40 << 20))).decode()
    plain = base64.b64encode(SECRET.encode()).decode()
    assert kinds(f"{bomb} and {plain}") == {"assign"}
    late = plain + " x" + " " * 9_000_000
    assert kinds(base64.b64encode(zlib.compress(b", " * (34 << 20) + late.encode() + b" ," * 2_000_000)).decode()) == {"assign"}


def test_pieces_change_nothing(monkeypatch):
    """Whatever the place where a piece ends: matches, runs, escapes and compressed data go on in the next."""
    rng = random.Random(5)
    filler = ["word ", "a/b-c_d", "%2541", "&#65;", "\\u0041", " , ", "\n", "x", "  "]
    for _ in range(25):
        inner = base64.b64encode(zlib.compress(bytes(rng.randrange(256) for _ in range(4000)) + SECRET.encode())).decode()
        for late in (SECRET, inner, SECRET.encode().hex(), urllib.parse.quote(base64.b64encode(SECRET.encode()).decode() + "=", safe="")):
            body = "".join(rng.choices(filler, k=rng.randrange(900))) + " " + late + " " + "".join(rng.choices(filler, k=rng.randrange(900)))
            text = f"see {base64.b64encode(zlib.compress(body.encode())).decode()} end"
            whole = secrets.scan_text(text)
            with monkeypatch.context() as context:
                context.setattr(secrets, "PIECE", 2048)
                assert secrets.scan_text(text) == whole
            assert "assign" in {kind for kind, _, _ in whole[1]}


def test_base64_of_either_alphabet_over_lines_and_after_paths():
    raw = b"config says ok~~~?? " + SECRET.encode()
    url = base64.urlsafe_b64encode(raw).decode()
    assert "-" in url and kinds(f"see {url} end") == {"assign"}
    under = base64.urlsafe_b64encode(b"????????? " + SECRET.encode()).decode()
    assert "_" in under and kinds(under) == {"assign"}
    rng = random.Random(7)
    noise = bytes(rng.randrange(256) for _ in range(300))
    for data in (b"Some words before it, so that it is over the line: " + SECRET.encode(), zlib.compress(noise + SECRET.encode()), gzip.compress(noise + SECRET.encode())):
        for encode in (base64.b64encode, base64.urlsafe_b64encode):
            one = encode(data).decode()
            for size in (20, 64, 76):
                for stop in ("\n", "\r\n", "\n    "):
                    lines = stop.join(one[i : i + size] for i in range(0, len(one), size))
                    assert "assign" in kinds(f"as follows:\n{lines}\nend"), (size, stop)
            for path in ("a/", "/srv/data/", "id-", "some_name_", "x/yz/"):
                assert "assign" in kinds(f"see {path}{one} end"), path
    wrapped = base64.encodebytes(raw * 3).decode()
    assert "hunter2" not in secrets.redacted(f"a {wrapped} z", secrets.scan_text(f"a {wrapped} z")[1])


def test_layers_of_any_characters_are_searched():
    for raw in (
        f"caf\u00e9\u00a0{SECRET}".encode(),
        f"\ufeff{SECRET}".encode(),
        f"\U0001f468\u200d\U0001f469 {SECRET}\f\x1b[31m\0".encode(),
        b"\xe9\xff " + SECRET.encode() + b" \xfe",
        SECRET.encode("utf-16"),
        SECRET.encode("utf-16-be"),
        b"x" + SECRET.encode("utf-16-le"),
        SECRET.encode("utf-32"),
        base64.b64encode(SECRET.encode()).decode().encode("utf-16"),
    ):
        for packed in (base64.b64encode(raw).decode(), base64.b64encode(zlib.compress(raw)).decode(), raw.hex()):
            assert kinds(f"see {packed} end") >= {"assign"}, (raw, packed)


def test_percent_runs_with_a_byte_that_is_no_utf_8():
    escaped = "".join(f"%{b:02X}" for b in SECRET.encode())
    assert kinds(f"a %E9{escaped}%FF b") == {"assign"}
    assert kinds("".join(f"%{b:02x}" for b in "é\u20ac\U0001f600".encode()) + escaped + "%C3") == {"assign"}
