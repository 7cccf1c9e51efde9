import hashlib
import random
import re
from datetime import date, timedelta

from lendspan.llm import pii


def rewritten(spark, texts, key="k"):
    rows = spark.createDataFrame([(i, t, "other") for i, t in enumerate(texts)], "doc_id long, text string, n_values string")
    found = pii.pseudonyms(rows, key)
    assert found.columns == ["doc_id", "text", "n_values"]
    by_id = {r.doc_id: r for r in found.collect()}
    return [(by_id[i].text, by_id[i].n_values) for i in range(len(texts))]


def luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def iban_ok(text):
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def test_values_are_replaced_within_their_format(spark):
    texts = [
        "mail ann.lee+7@mail.example.com, call +1 (487) 555-7209 now",
        "card 4111 1111 1111 1111 and 4111111111111111, host 175.102.247.55",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 123-45-6789',
        "born 2001-02-28 or 28/02/2001; GB82 WEST 1234 5698 7654 32.",
    ]
    (mail, n0), (card, n1), (secret, n2), (born, n3) = rewritten(spark, texts)
    assert (n0, n1, n2, n3) == (2, 3, 2, 3)
    assert re.fullmatch(r"mail [a-z]{3}\.[a-z]{3}\+\d@mail\.example\.com, call \+1 \(\d{3}\) \d{3}-\d{4} now", mail)
    assert "ann" not in mail and "7209" not in mail
    spaced, plain, host = re.fullmatch(r"card ([\d ]{19}) and (\d{16}), host ([\d.]+)", card).groups()
    assert luhn(plain) and spaced.replace(" ", "") == plain != "4111111111111111"
    assert all(0 <= int(o) <= 255 for o in host.split(".")) and host != "175.102.247.55"
    assert re.fullmatch(r'token = "[0-9a-f]{40}" and \d{3}-\d\d-\d{4}', secret) and "04dbe" not in secret
    iso, slashed, account = re.fullmatch(r"born ([\d-]+) or ([\d/]+); ([A-Z\d ]+)\.", born).groups()
    assert date.fromisoformat(iso).strftime("%d/%m/%Y") == slashed and iso != "2001-02-28"
    assert iban_ok(account) and account.startswith("GB") and account != "GB82 WEST 1234 5698 7654 32"


def test_what_fails_validation_stays(spark):
    texts = ["4111111111111112", "999.1.1.300", "2001-02-30", "GB82 WEST 1234 5698 7654 33", "version 1.2.3 of 2024", "", None, "no digits"]
    assert rewritten(spark, texts) == [(t, 0) for t in texts]


def test_equal_values_stay_linked_and_distinct_values_apart(spark):
    hosts = [f"10.{a}.{b}.7" for a in range(12) for b in range(12)]
    cards = []
    for n in range(150):
        body = f"{400000000000000 + n * 977:015d}"
        cards.append(next(body + str(c) for c in range(10) if luhn(body + str(c))))
    days = [date.fromordinal(date(1990, 1, 1).toordinal() + 31 * n).isoformat() for n in range(150)]
    for values in (hosts, cards, days):
        once = [t for t, n in rewritten(spark, values) if n == 1]
        assert len(set(once)) == len(values) and not set(once) & set(values)
        assert [t for t, _ in rewritten(spark, [f"x {v} y" for v in values])] == [f"x {t} y" for t in once]
    assert rewritten(spark, hosts[:3], "other key") != rewritten(spark, hosts[:3])


def keyed(kind, round_no, other, at):
    found = hashlib.sha256(f"k|{kind}|{round_no}|{other}|{(at - 1) // 16}".encode()).hexdigest()
    place = 4 * ((at - 1) % 16)
    return int(found[place : place + 4], 16)


def moved(char, by, classes):
    for members in classes:
        if char in members:
            return members[(members.index(char) + by) % len(members)]
    return char


PLAIN = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõö")


def permuted(value, kind, classes=PLAIN):
    halves = [value[: len(value) // 2], value[len(value) // 2 :]]
    for i in range(8):
        other = halves[1 - i % 2]
        halves[i % 2] = "".join(moved(c, keyed(kind, i, other, k + 1), classes) for k, c in enumerate(halves[i % 2]))
    return "".join(halves)


def permuted_pair(a, b, size, kind):
    pair = [a, b]
    for i in range(8):
        pair[i % 2] = (pair[i % 2] + keyed(kind, i, pair[1 - i % 2], 1)) % size
    return pair


def laid_out(value, new):
    rest = iter(new)
    return "".join(next(rest) if c.isdigit() or "A" <= c <= "Z" else c for c in value)


def test_pseudonyms_by_definition(spark):
    rng = random.Random(5)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    expected = {}
    for _ in range(25):
        body = "4" + some("0123456789", rng.choice([12, 14, 15]))
        number = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        new = permuted(body, "card")
        expected[number] = next(new + str(c) for c in range(10) if luhn(new + str(c)))

        ssn = f"{some('0123456789', 3)}-{some('0123456789', 2)}-{some('0123456789', 4)}"
        expected[ssn] = laid_out(ssn, permuted(ssn.replace("-", ""), "ssn"))

        national = some("23456789", 10)
        phone = f"+1 ({national[:3]}) {national[3:6]}-{national[6:]}"
        expected[phone] = laid_out(phone, "1" + permuted(national, "phone"))

        o = [rng.randrange(256) for _ in range(4)]
        a, b = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, "ip")
        expected[".".join(map(str, o))] = f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"

        day = rng.randrange(-20_000, 90_000)
        block, within = divmod(day, 270 * 270)
        a, b = permuted_pair(within // 270, within % 270, 270, "date")
        start = date(1900, 1, 1)
        expected[(start + timedelta(day)).isoformat()] = (start + timedelta(block * 270 * 270 + a * 270 + b)).isoformat()

        local = some("abcxyzABC019._é", rng.randint(1, 40))
        expected[f"{local}@mail.example.org"] = f"{permuted(local, 'email')}@mail.example.org"

        secret = some("0123456789abcdef", rng.randint(16, 64))
        expected[f"token={secret}"] = f"token={permuted(secret, 'secret', ('0123456789abcdef',))}"

        account = some("ABCDEFGHIJ", 4) + some("0123456789", 14)
        iban = next(x for c in range(2, 99) if iban_ok(x := f"GB{c:02d}{account}"))
        new = permuted(account, "iban")
        expected[iban] = next(x for c in range(2, 99) if iban_ok(x := f"GB{c:02d}{new}"))
    values = list(expected)
    assert rewritten(spark, [f"<{v}>" for v in values]) == [(f"<{expected[v]}>", 1) for v in values]


def test_a_long_text_with_many_values(spark):
    text = " ".join(f"word{i} 10.0.{i % 256}.9" for i in range(3000))
    ((found, n),) = rewritten(spark, [text])
    assert n == 3000 and len(set(re.findall(r"\d+\.\d+\.\d+\.\d+", found))) == 256


def test_empty_table(spark):
    assert pii.pseudonyms(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0
