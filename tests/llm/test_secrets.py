"""Secret scans: base spans, layers, mapping, cycles, redaction."""

import base64
import bz2
import gzip
import random
import re
import time
import urllib.parse
import zlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hazeline.llm import secrets
from hazeline.llm.secrets import redact, redacted, scan, secret_spans

SECRET = "password=hunter2hunter2"


def plain_base(text):
    kinds = [(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
             (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)]
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(kinds) for m in re.finditer(p, text) if len(m[g]) >= n)


def shown(text):
    return [text[a:b] for a, _, b in scan(text.encode())[1]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "=", ": ", '"', "'", "SECRET", "api_key", "apikey:", "AKIA", "Z9" * 7, "ab12" * 8, "é", "%3D", "\\u003d", "K", " ", "x" * 20, "%", "\\"]), max_size=14).map("".join))
def test_base_spans_stay(text):
    base, spans = scan(text.encode())
    assert base == plain_base(text) and set(base) <= set(spans) and spans == sorted(set(spans))
    assert all(0 <= a < b <= len(text) for a, _, b in spans)


def test_url_and_unicode_escapes_map_to_code_points():
    assert shown("é x password%3Dhunter2hunter2 y") == ["password%3Dhunter2hunter2"]
    assert shown("é x password%253Dhunter2hunter2 y") == ["password%253Dhunter2hunter2"]
    assert shown(r"é password=hunter2hunter2 y") == [r"password=hunter2hunter2"]
    assert shown(r"😀 \ud800 \x74oken: abcdefgh1") == [r"\x74oken: abcdefgh1"]


def test_base64_and_compression():
    for data in (SECRET.encode(), gzip.compress(SECRET.encode()), zlib.compress(SECRET.encode()), bz2.compress(gzip.compress(SECRET.encode()))):
        run = base64.b64encode(data).decode()
        for text in (f"see {run} there", f"a/{run.replace('+', '-').replace('/', '_')}"):
            assert any(run.rstrip("=").replace("+", "-").replace("/", "_") in s.replace("+", "-").replace("/", "_") for s in shown(text)), text


def test_layers_with_odd_characters():
    for data in ("\ufeff" + SECRET, "\x1b[31m" + SECRET + "\x1b[0m", SECRET + "\x00", "\u00a0" + SECRET + "\u200b\f"):
        for packed in (data.encode(), gzip.compress(data.encode()), data.encode() + b" \xff", b"\xff " + data.encode()):
            run = base64.b64encode(packed).decode()
            assert shown(f"see {run} there") == [run], data


def test_every_block_between_separators():
    a, b = (base64.b64encode(f"{w} {SECRET} {w}".encode()).decode().rstrip("=") for w in ("one", "three"))
    for mark in "/-_":
        got = shown(f"x {a}{mark}{b} y")
        assert any(a in s for s in got) and any(b in s for s in got)
    inner = base64.b64encode(("???>>>~~~ " + SECRET + " ???").encode()).decode().rstrip("=")
    assert "/" in inner and any(inner in s for s in shown(f"x/{inner}/y"))


def test_wrapped_blocks():
    rnd = random.Random(4)
    noise = "".join(rnd.choice("ghijklmn opqr") for _ in range(300))
    for data in ((noise[:51] + SECRET + " " + noise[:40]).encode(), gzip.compress((noise + SECRET).encode())):
        for width, end in ((64, "\n"), (76, "\r\n")):
            run = base64.b64encode(data).decode()
            block = end.join(run[i:i + width] for i in range(0, len(run), width))
            assert any(block in s for s in shown(f"see\n\n{block}\n\nend")), (width, data)


def test_all_gzip_members_and_valid_stretches_of_escapes():
    run = base64.b64encode(gzip.compress(b"nothing") + gzip.compress(SECRET.encode())).decode()
    assert shown(f"see {run} there") == [run]
    coded = "".join(f"%{c:02X}" for c in SECRET.encode())
    assert shown(f"é %E9{coded}%E9 y") == [coded]


def test_nested_layers_and_outer_span():
    inner = base64.b64encode(gzip.compress(("id " + urllib.parse.quote(SECRET, safe="")).encode())).decode()
    outer = base64.b64encode(f"note: {inner}".encode()).decode()
    text = "é" * 5 + " " + outer + " tail"
    assert shown(text) == [outer]


def test_cycles_end(monkeypatch):
    run = base64.b64encode(b"loop " * 8).decode()
    monkeypatch.setattr(secrets, "block_texts", lambda r: [run])
    assert scan(f"go {run} on".encode()) == ([], [])


def test_redaction_leaves_the_rest():
    text = f"é a {SECRET}, b AKIA{'Q' * 16} c"
    assert redact(text.encode()).decode() == "é a [assign], b [access] c"
    assert redact(b"nothing here") == b"nothing here"


def test_frames(spark):
    rnd = random.Random(2)
    rows = [(1, None), (2, ""), (3, SECRET), (3, SECRET), (None, "AKIA" + "A" * 12), (5, "word " * 40_000 + SECRET + " " + "0123456789abcdef" * 2)]
    rows += [(10 + i, " ".join(rnd.choice(["token=abcdefgh", "x", "é", "deadbeef" * 4, "passwd: 'a'"]) for _ in range(9))) for i in range(20)]
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, base int, spans string")
    got = sorted(((r.id, [(s.start, s.kind, s.end) for s in r.base]) for r in secret_spans(docs).collect()), key=str)
    assert got == sorted(((d, [(a, secrets.KINDS[k], b) for a, k, b in plain_base(t or "")]) for d, t in rows), key=str)
    clean = docs.select("doc_id", redacted(F.col("text")).alias("t")).collect()
    assert sum(r.t is None for r in clean) == 1 and not any(SECRET in (r.t or "") for r in clean)
    assert secret_spans(docs.limit(0)).count() == 0


def plain_kinds(data, depth=0):
    """Kinds of secrets in the data or any layer below it, by trying every start of every run and every place of every block."""
    text, found = data.decode(errors="replace"), set()
    found |= {k for _, k, _ in plain_base(text)}
    if depth == 5:
        return found
    below = set()
    for run in re.findall(r"[A-Za-z0-9+/_-]{19,}", text):
        run = run.replace("-", "+").replace("_", "/")
        for a in range(len(run) - 18):
            body = run[a:len(run) - ((len(run) - a) % 4 == 1)]
            below.add(base64.b64decode(body + "=" * (-len(body) % 4)))
    for at in range(len(data)):
        for head, tool in ((b"\x1f\x8b\x08", lambda: zlib.decompressobj(31)), (b"x\x9c", zlib.decompressobj), (b"BZh", bz2.BZ2Decompressor)):
            if data.startswith(head, at):
                try:
                    below.add(tool().decompress(data[at:]))
                except (zlib.error, OSError, EOFError):
                    pass
    if re.search("%[0-9A-Fa-f]{2}", text):
        below |= {urllib.parse.unquote(text, errors="replace").encode(), urllib.parse.unquote_to_bytes(text)}
    if "\\u" in text:
        below.add(re.sub(r"\\u([0-9A-Fa-f]{4})", lambda m: chr(int(m[1], 16)), text).encode(errors="replace"))
    for layer in below - {data}:
        hints = [b"pass", b"AKIA", b"token", b"%", b"\\u", b"\x1f\x8b\x08", b"x\x9c", b"BZh"]
        if any(h in layer for h in hints) or re.search(rb"[A-Za-z0-9+/_-]{19,}|[0-9a-f]{32,}", layer):
            found |= plain_kinds(layer, depth + 1)
    return found


def test_random_nestings_equal_brute_force():
    rnd = random.Random(12)
    inner = [SECRET, "AKIA" + "Q" * 16, "token: 'abcdefgh1'", "0123456789abcdef" * 2, "nothing secret here", "passwordless"]
    wraps = [lambda b: base64.b64encode(b), lambda b: base64.urlsafe_b64encode(b).rstrip(b"="), gzip.compress, zlib.compress, bz2.compress,
             lambda b: b"some words " + b + b" and more", lambda b: urllib.parse.quote_from_bytes(b, safe="").encode()]
    seen = set()
    for _ in range(80):
        data = rnd.choice(inner).encode()
        for _ in range(rnd.randint(0, 3)):
            data = rnd.choice(wraps)(data)
        run = base64.b64encode(data).decode().rstrip("=")
        run = rnd.choice(["", "abc", "x", "a/b/", "k_" * 12, "abc/" * 18]) + run + rnd.choice(["", "/cd", "-e", "zz"])
        if len(run) < 19:
            continue
        text = f"é see {run} there"
        base, spans = scan(text.encode())
        start = text.index(run)
        want = plain_kinds(run.encode()) - {k for _, k, _ in plain_base(run)}
        got = {(a, k, b) for a, k, b in spans if (a, k, b) not in base}
        assert {k for _, k, _ in got} - {k for _, k, _ in base} == want, run
        assert all((a, b) == (start, start + len(run)) for a, _, b in got)
        seen |= want
    assert seen == {0, 1, 2}


def test_spans_do_not_depend_on_separators_before_a_block():
    for data in (SECRET.encode(), gzip.compress(SECRET.encode()), b"?>/" * 9 + SECRET.encode()):
        block = base64.b64encode(data).decode().rstrip("=")
        for n in (0, 3, 16, 17, 18, 40):
            run = "abc/" * n + block + "/cd"
            assert shown(f"x {run} y") == [run]
        for around in (f"key: |\n    {block}\n", f"abc{block}", f'"{block}"'):
            assert any(block in s for s in shown(around))


def test_indented_lines_are_one_block():
    run = base64.b64encode(gzip.compress(("".join(random.Random(5).choices("abcdefghijklmnop", k=300)) + SECRET).encode())).decode()
    block = "\n    ".join(run[i:i + 60] for i in range(0, len(run), 60))
    assert any(block in s for s in shown(f"data: |\n    {block}\n\nend"))


def test_a_cut_block_gives_what_is_there():
    packed = zlib.compress((SECRET + " ").encode() + random.Random(1).randbytes(30_000))
    assert len(shown("x " + base64.b64encode(packed[:20_000]).decode().rstrip("=") + " y")) == 1


def test_large_layers_in_bounded_pieces():
    """A megabyte of base64 in seconds; unpacked data far larger than its block, a secret at its end."""
    noise = base64.b64encode(random.Random(3).randbytes(750_000)).decode()
    began = time.process_time()
    assert scan(noise.encode()) == ([], [])
    assert time.process_time() - began < 15
    data = b"plain; " * 3_000_000 + SECRET.encode()
    run = base64.b64encode(gzip.compress(gzip.compress(data))).decode()
    assert shown(f"see {run} there") == [run]


def test_a_batch_is_not_held_as_python_texts(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa
    from pyspark.sql import functions as F

    taken = []
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: taken.append(f) or (lambda c: c))
    secrets.redacted(F.col("text"))
    texts = pa.array([f"{'ab! ' * 1000}{i}" for i in range(2000)] + [None, "", "password=abcdefgh"])
    tracemalloc.start()
    found = taken[0](texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.slice(0, 2002).equals(texts.slice(0, 2002)) and found[2002].as_py() == "[assign]"
    assert peak < 3_000_000 < texts.nbytes and taken[0](texts.slice(0, 0)).type == pa.string()
