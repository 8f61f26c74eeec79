import hashlib
import random
import re
import time

import pytest
from helpers import awkward_rows, documents

from clickweave.llm import secrets


def literals(text):
    return [text[a:b] for a, b, k in secrets.scan_text(text)[1] if k == "literal"]


@pytest.mark.parametrize("text, found", [
    ('key = "zX81kd93jQmP"\nuser = "zX81kd93jQmQ"\ndb_password = key\n', ["zX81kd93jQmP"]),
    ('a = b\nb = c\nc = "flow1ngT0ken"\nsession_secret = a', ["flow1ngT0ken"]),
    ("a = password\npassword = a\n", []),
    ('config["api_key"] = \'aB3dE5fG7h\'', ["aB3dE5fG7h"]),
    ('{"db_pwd": "q9W8e7R6t5", "user": "q9W8e7R6t5"}', ["q9W8e7R6t5"]),
    ("DB_PWD=s3cr3t-value\nDB_USER=s3cr3t-valu3", ["s3cr3t-value"]),
    ('set_password("Tr0ub4dor&3")', ["Tr0ub4dor&3"]),
    ('put("passphrase", "c0rrect-horse")', ["c0rrect-horse"]),
    ("<password>S3same!open</password>", ["S3same!open"]),
    ('passwd = "ab" + "cd12EF"', ["ab", "cd12EF"]),
    ('auth_token: str = r"tok_9f8e7d"', ["tok_9f8e7d"]),
    ("mysql --password hunter22 -u x", ["hunter22"]),
    ("Authorization: Bearer abcDEF123456", ["abcDEF123456"]),
    ('clientAuthKey => "k4jd8s7dj2"', ["k4jd8s7dj2"]),
    ('pwd = "zZ9\\"quote7"', ['zZ9\\"quote7']),
    # clean: comparisons, names about secrets, placeholders, prose, weak words, unterminated strings
    ('pwd == "notassigned1"', []), ('pwd_length = "123456789a"', []), ('pwd = "${DB_PASSWORD}"', []), ('pwd = "xxxxxxxxxx"', []),
    ("the credentials: whatever, don't worry; a private: matter", []), ("pwd = 'abc", []), ('key = "zX81kd93jQmP"', []), ("", []),
])
def test_pairs_and_constants(text, found):
    assert literals(text) == found


def base(text):
    """The three patterns by a plain left-to-right search."""
    out = []
    assign = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (kind, pattern, least) in enumerate([("assign", assign, 6), ("access", "(AKIA[A-Z0-9]+)", 20), ("hex", "([0-9a-f]+)", 24)]):
        at = 0
        while m := re.compile(pattern).search(text, at):
            if len(m[1]) >= least:
                out.append((m.start(), k, m.end(), kind))
            at = m.end()
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)), [x[3] for x in out]


def test_scan_against_plain_search(spark):
    r = random.Random(6)
    bits = ['token = "', "TOKEN:abc", "api_key=", "ApiKey = '", "AKIA" + "B7" * 9, "AKIA123", "0af9" * 7, "0af9" * 3, "ſecret=abcdefgh", "toKen=abcdefgh",
            '"', " ", "\n", "é漢🙂", "password", "= ", "zX81kd93jQmP", ",", "secret:", "x = "]
    rows = awkward_rows() + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(1, 60))), "en", "s") for i in range(300)]
    got = secrets.scan(documents(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, base(t or "")[0]) for i, t, *_ in rows)
    have = []
    for x in got:
        all_spans = [s for s in x.spans.split(",") if s]
        kept = [s for s in all_spans if not s.startswith("literal")]
        assert hashlib.sha256(",".join(kept).encode()).hexdigest() == x.base_sha256
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(s.startswith(k) for s in kept) for k in ("assign", "access", "hex")]
        assert all_spans == sorted(all_spans, key=lambda s: (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0])))
        have.append((x.doc_id is None, x.doc_id or 0, ",".join(kept)))
    assert sorted(have) == want
    assert any("literal" in x.spans for x in got)
    assert secrets.scan(documents(spark, [])).collect() == []


@pytest.mark.parametrize("text", ['"', "'", '"""a"', 'password="', "<a>", '\\"', "a.", "a=a=", "password=a+", "--a ", 'a("b" ', "a = a + a\npassword = a\n",
                                  "password = a\na = password\n", "token ", "`", "x:"])
def test_lexing_is_linear(text):
    seconds = []
    for n in (20_000, 80_000):
        started = time.process_time()
        secrets.scan_text("token " + text * (n // len(text)))
        seconds.append(time.process_time() - started)
    assert seconds[1] < 10 * seconds[0] + 0.5
