"""Secret spans against a plain version of the base patterns, and the lexer on source text."""

import hashlib
import re

from trialstats.llm import catalog, secrets

SF = "/root/testdata/sf0.01"


def plain(text):
    spans = []
    ci = "".join
    words = "|".join(ci(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    patterns = [
        ("assign", rf"({words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    for order, (kind, pattern, good) in enumerate(patterns):
        spans += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


CASES = [
    None, "", "password=token: abcdefgh", "PassWord = 'hunter2x'", "toKen=abcdefgh toKen=abcdefgh", "api_key:abcdef apikey: \"abc\"",
    "é" * 50 + " secret:abc123 " + "🙂AKIA" + "A1" * 9, "AKIAAKIA" * 4, "deadbeef" * 3, "deadbeef" * 2, "token=" + "f" * 40,
    "x" * 100000 + " token=abcdef1", "ſecret=abcdefgh",
]


def found(text):
    return {text[s[1]:s[2]] for s in secrets.find(text) if s[0] == "literal"}


def test_base_spans_against_plain(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id bigint, text string").selectExpr("*", "1 AS row", "2 AS secrets")
    out = {r.doc_id: r for r in secrets.secret_spans(df).collect()}
    for i, t in enumerate(CASES):
        want = plain(t)
        assert out[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert out[i].n_assign == want.count("assign") and out[i].n_access == want.count("access") and out[i].n_hex == want.count("hex")
        assert set(filter(None, want.split(","))) <= set(out[i].spans.split(","))


def test_whole_table(spark):
    out = {r.doc_id: r for r in catalog.op7_secrets(spark, SF).collect()}
    docs = catalog.documents(spark, SF).collect()
    assert len(out) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in out.values()) > 10
    for d in docs:
        assert out[d.doc_id].base_sha256 == hashlib.sha256(plain(d.text).encode()).hexdigest()


def test_literals_by_target_name():
    assert found('dbPassword = "x9!kd#Lq2"') == {"x9!kd#Lq2"}
    assert found('value = "q8Zr!t5Wm"\nclient_secret_value = value') == {"q8Zr!t5Wm"}
    assert found('a = "q8Zr!t5Wm"\nb = a\nc: b\nauth_key := c') == {"q8Zr!t5Wm"}
    assert found('p = "q8Zr!"\nprivateKey = p + "t5Wm0a1"') == {"t5Wm0a1"}
    assert found("config['access-key'] = 'Zk3$kd92ls'") == {"Zk3$kd92ls"}
    assert found('{"pwd": "Zk3!kd92ls", "color": "Zk3!kd92lt"}') == {"Zk3!kd92ls"}
    assert found("db_credentials=Zk3!kd92ls") == {"Zk3!kd92ls"}


def test_phrases_and_password_hashes():
    phrase = "correct horse battery staple"
    assert found(f'passphrase = "{phrase}"') == {phrase}
    text = f'password = "{phrase}"'
    assert secrets.redacted(text, secrets.find(text)) == 'password = "[SECRET]"'
    bcrypt, crypt = "$2b$12$R9h/cIPz0gi.URNNX3kh2OPST9/PgBkqquzi.Ss7KIUgO2t0jWMUW", "$6$rounds$Vt9pQ1/xk.Zw"
    assert found(f"user_pwd: '{bcrypt}'\nroot_pwd={crypt}") == {bcrypt, crypt}
    assert found('db_pwd = "%9xT!kd#Lq2"\nmy_pwd = "{9xT!kd#Lq3"\nhis_pwd = "<9xT!kd#Lq4"') == {"%9xT!kd#Lq2", "{9xT!kd#Lq3", "<9xT!kd#Lq4"}
    for text in ['pwd = "${DB_PASS1:-}"', 'pwd = "$DB_PASS1"', "pwd=%DB_PASS1%", "pwd = '<pass 1 here>'", "pwd: '{{ db.pass1 }}'",
                 'pwd = "${USER_1}:${PASS_1}"', 'token_hint = "the name of your first pet"', "pwd = $config1.pass"]:
        assert found(text) == set(), text


def test_literals_that_span_lines():
    assert found('passphrase = """correct horse\n  battery staple"""\nx = 1') == {"correct horse\n  battery staple"}
    assert found("auth_key = '''\nq8Zr!t5Wm\n'''") == {"q8Zr!t5Wm"}
    assert found('doc = """\npwd = "q8Zr!t5Wm"\n"""\npwd: """') == {"q8Zr!t5Wm"}
    text = "a:\n  - signing_key: |\n      q8Zr!t5Wm\n\n      t5Wm0a1x\n    user: bob12345\nb: >-\n  Zk3!kd92ls\n"
    assert found(text) == {"q8Zr!t5Wm\n\n      t5Wm0a1x"}
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIEowIBAAKCAQEA\nq8Zrt5Wm\n-----END RSA PRIVATE KEY-----"
    text = f"see\n{pem}\nend"
    assert found(text) == {pem} and secrets.redacted(text, secrets.find(text)) == "see\n[SECRET]\nend"
    assert found(pem.replace("PRIVATE", "PUBLIC")) == set()
    text = 'k = """' + pem + '"""\nprivate_key = k'
    assert secrets.redacted(text, secrets.find(text)).count("q8Zrt5Wm") == 0
    for text in ['a = """' * 30000, "-----BEGIN PRIVATE KEY-----" * 30000, "p = p + p\n" * 200, "a: |\n" * 30000]:
        secrets.find(text)


def test_names_defined_below_their_use():
    assert found('auth_key := c\nc: b\nb = "q8Zr!t5Wm"') == {"q8Zr!t5Wm"}
    assert found("pwd = a\na = b\nb = a") == set()


def test_clean_text_stays():
    for text in ["The answer: nobody knows it.", "color = '#aabbcc12'", "pwd = ''", "my_pwd = '<your password here>'", "pwd=${DB_PASS}",
                 "monkey = 'Zk3!kd92ls'", "if token == 'Zk3!kd92ls': pass", "x::pwd::y", "pwd:", "credentials: please ask at the desk"]:
        assert found(text) == set(), text


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é password=abcdef12, AKIA" + "B" * 16), (2, None), (3, "clean")], "doc_id bigint, text string")
    out = {r.row.doc_id: r.redacted for r in secrets.scan(df).collect()}
    assert out == {1: "é password=[SECRET], [SECRET]", 2: None, 3: "clean"}
    assert secrets.scan(df.limit(0)).count() == 0


def test_long_lines_stay_quick():
    text = "a" * 200000 + "=" + "b:" * 50000 + "'" + '"\\' * 20000
    secrets.find(text)
