"""Surrogates by their properties; quotation links against a plain version."""

import re

from pyspark.sql import functions as F

import pytest

from codeweft.llm import quotes
from codeweft.llm import surrogates as s

TEXTS = [
    "Mail anna.berg@Shop.example.com or ANNA.BERG@shop.example.com; call +1 (017) 555-7713 or +1 017 555 7713. From 97.51.17.173.",
    "Mr John Smith met Mrs. Maria Smith. Mr Smith paid 9807915762804490, SSN 123-45-6789, IBAN DE89 3704 0044 0532 0130 00.",
    None,
    "",
    "Госпожа Анна Иванова и Господин Иван Иванов",
    'plain 12 a@b 3.14 2024-01-02 token = "681c09b8e90e7e8c9575180f595f646cf2969054" 1.2.3.4.5 999.1.1.1',
]


def rewritten(docs, key="k"):
    return {r.doc_id: r for r in s.replace_entities(docs, key).collect()}


def test_layout_coreference_and_key(docs_of):
    docs = docs_of(*enumerate(TEXTS), (1, TEXTS[1]))
    rows, other = rewritten(docs), rewritten(docs, "another")
    assert rows[2].text is None and rows[3].text == "" and rows[5].text == TEXTS[5] and rows[5].n_entities == 0
    mails = re.findall(r"\S+@[\w.]+", rows[0].text)
    assert mails[0].lower() == mails[1].lower() and mails[1].split("@")[0].isupper() and mails[0].endswith(".com")
    assert "anna" not in rows[0].text.lower() and "97.51.17.173" not in rows[0].text
    phones = [re.sub(r"[^\d+]", "", p) for p in re.findall(r"\+1[ ()\d-]+\d", rows[0].text)]
    assert len(set(phones)) == 1 and phones[0] != "+10175557713"
    m = re.fullmatch(
        r"Mr (\w+) (\w+) met Mrs\. (\w+) (\w+)\. Mr (\w+) paid \d{16}, SSN \d{3}-\d\d-\d{4}, IBAN DE\d\d(?: \d{4}){4} \d\d\.", rows[1].text
    )
    assert m and m[2] == m[4] == m[5] and m[3].endswith("na") and m[1].endswith("n") and "Smith" not in rows[1].text
    assert re.fullmatch(r"Госпожа [А-Я][а-я]+ [А-Я][а-я]+ и Господин [А-Я][а-я]+ [А-Я][а-я]+", rows[4].text)
    assert rows[0].text != other[0].text
    assert (rows[1].n_name, rows[1].n_card, rows[1].n_ssn, rows[1].n_iban, rows[0].n_email, rows[0].n_phone, rows[0].n_ip) == (3, 1, 1, 1, 2, 2, 1)


def test_surrogates_stay_distinct_when_they_are_few(docs_of):
    """26 one-letter addresses at one host: nearly all first attempts are taken."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = docs_of(*((k, f"to {c}@b.com now") for k, c in enumerate(letters)), (50, "a@b.com z@b.com"))
    rows = rewritten(docs)
    new = [rows[k].text.split()[1] for k in range(26)]
    assert len(set(new)) == 26 and not set(new) & {f"{c}@b.com" for c in letters}
    assert rows[50].text.split() == [new[0], new[25]]


def test_dense_formats_stay_distinct_or_are_refused(docs_of):
    dense = [(k, f"+1 {k // 100:02d} {k % 100:02d}") for k in range(6000)]
    with pytest.raises(ValueError, match="phone format"):
        s.replace_entities(docs_of(*dense), "key")
    some = [(k, f"+1 {k // 100:02d} {k % 100:02d}") for k in range(0, 10_000, 5)]
    out = [r.text for r in s.replace_entities(docs_of(*some), "key").collect()]
    assert len(set(out)) == len(some) == 2000 and not set(out) & {t for _, t in some}


def plain_luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_iban(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def test_formats_stay_valid(docs_of):
    cards = ["4111 1111 1111 1111", "5500005555555559", "378282246310005", "4111111111111112"]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE00 3704 0044 0532 0130 00"]
    socials = ["123-45-6789", "899-01-0001", "665-99-9999"]
    phones = ["+49 30 1234567", "+1 555 123 4567", "+7 495 1234567", "+358 9 1234567", "+420 123 456 789", "+44 20 7946 0958"]
    texts = [f"{kind} {x} end" for kind, xs in (("c", cards), ("i", ibans), ("s", socials), ("p", phones)) for x in xs]
    for key in ("k", "another", "third"):
        got = [r.text.split(" ", 1)[1][:-4] for r in sorted(s.replace_entities(docs_of(*enumerate(texts)), key).collect(), key=lambda r: r.doc_id)]
        new_cards, new_ibans, new_socials, new_phones = got[:4], got[4:7], got[7:10], got[10:]
        assert not set(got) & {*cards, *ibans, *socials, *phones}
        assert [plain_luhn(re.sub(r"\D", "", c)) for c in new_cards][:3] == [True] * 3
        assert [plain_iban(i) for i in new_ibans][:2] == [True] * 2 and [i[:2] for i in new_ibans] == ["DE", "GB", "DE"]
        for n in new_socials:
            area, group, serial = n.split("-")
            assert area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        codes = ["+49 ", "+1 ", "+7 ", "+358 ", "+420 ", "+44 "]
        assert all(n.startswith(c) for n, c in zip(new_phones, codes, strict=True))
        assert [re.sub(r"\d", "0", a) for a in new_phones] == [re.sub(r"\d", "0", a) for a in phones]


def test_no_documents(docs_of):
    assert s.replace_entities(docs_of((1, "x")).where("false"), "k").count() == 0
    odd = docs_of((1, "a@bb.com")).withColumns({c: F.lit(1) for c in ("found", "h", "kind", "value", "attempt")})
    assert rewritten(odd)[1].n_email == 1


MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?\n\nSecond part."),
    (1, 1, "assistant", "On Monday, A wrote:\n> how  are YOU?\nFine."),
    (1, 2, "user", "> > How are you?\n> Fine.\nGreat\n> unknown thing\nend"),
    (1, 3, "user", "> Great\nok"),
    (1, 3, "user", "again"),
    (1, 4, "user", "> ok\n>> Great\nlast"),
    (2, 0, "user", None),
    (2, 1, "user", ""),
    (2, 2, "user", "> Hello there.\nother conversation"),
    (3, 5, "user", "> later words\nearly"),
    (3, 6, "user", "later words"),
    (None, 1, "user", "> x\ny"),
    (1, None, "user", "> Great\nz"),
]


def plain(rows):
    def norm(t):
        return re.sub(r"\s+", " ", t.lower()).strip()

    def parse(text):
        own, runs, before = [], [], None
        lines = re.split(r"\r?\n", text or "")
        levels = [len(re.match(r"(?:[ \t]*>)*", x)[0].replace(" ", "").replace("\t", "")) for x in lines]
        for k, (line, level) in enumerate(zip(lines, levels, strict=True)):
            words = re.sub(r"^(?:[ \t]*>)+ ?", "", line)
            if not level and re.match(r"\s*On\b.*wrote:\s*$", line) and k + 1 < len(lines) and levels[k + 1]:
                before = None
            elif not level:
                own.append(line)
                before = None
            elif before == level:
                runs[-1][1].append(words)
            else:
                runs.append((level, [words]))
                before = level
        return own, runs

    def hashes(lines):
        whole = "\n".join(lines)
        out = [(0, norm(whole)), *((1, norm(p)) for p in re.split(r"\n\s*\n", whole)), *((2, norm(x)) for x in lines)]
        return [(g, t) for g, t in out if t]

    said = {}
    for c, turn, _, text in rows:
        for grain, t in hashes(parse(text)[0]):
            if c is not None and turn is not None:
                old = said.get((c, t), (turn, grain))
                said[c, t] = (min(old[0], turn), min(old[1], grain))
    out, parent = [], {}
    for c, turn, _, text in rows:
        own, runs = parse(text)
        found = []
        for level, lines in runs:
            best = [
                (g, said[c, t][1], said[c, t][0]) for g, t in hashes(lines)
                if c is not None and turn is not None and (c, t) in said and said[c, t][0] < turn
            ]
            if best:
                found.append((level, -min(best)[2]))
        if found:
            parent[c, turn] = -min(found)[1]
        out.append((c, turn, text if not runs else re.sub(r"^\s*\n|\s+$", "", "\n".join(own)), len(runs), len(found)))
    rows = []
    linked = {(c, turn): n for c, turn, _, _, n in out if n}
    for c, turn, text, n, _ in out:
        root = turn
        while (c, root) in parent:
            root = parent[c, root]
        rows.append(str((c, turn, text, parent.get((c, turn)), root, n, linked.get((c, turn), 0))))
    return sorted(rows)


def test_quotes_against_plain(llm):
    df = llm.createDataFrame(MESSAGES, "conv_id bigint, turn bigint, role string, text string")
    got = quotes.link_quotes(df.withColumns({c: F.lit(1) for c in ("lines", "own", "hash", "level")}))
    assert sorted(str((r.conv_id, r.turn, r.text, r.reply_to, r.root, r.n_quotes, r.n_linked)) for r in got.collect()) == plain(MESSAGES)
    assert quotes.link_quotes(df.where("false")).count() == 0


def test_long_chains_and_texts(llm):
    rows = [(1, k, "user", f"> words {k - 1}\nwords {k}" if k else "words 0") for k in range(40)]
    rows += [(2, 0, "user", "a line\n" * 5000), (2, 1, "user", "> a line\n" * 5000 + "end")]
    got = quotes.link_quotes(llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert {(r.conv_id, r.root) for r in got.collect()} == {(1, 0), (2, 0)}


PRIVATE = [
    "555-123-4567", "555.123.4567", "030 1234567", "1-800-555-1234", "555 123 4567", "030/1234567", "(030) 12345678", "020 7946 0958",
    "01 02 03 04 05", "+49 (0)30 1234567", "2001:db8::8a2e:370:7334", "2001:0DB8:0000:0000:0000:8a2e:0370:7334", "fe80::1", "::ffff:10.1.2.3",
]
PERSONS = {
    "Mr McDonald": ["McDonald"], "Mrs O'Brien": ["Brien"], "Mr J. Smith": [" J.", "Smith"], "Mr Jean-Luc D’Angelo": ["Jean", "Luc", "Angelo"],
    "Mr John Ronald Reuel Tolkien": ["John", "Ronald", "Reuel", "Tolkien"], "Dr Miller": ["Miller"], "Herr Dr. Schmidt": ["Schmidt"],
    "Ms J.R. SMITH": ["J.R", "SMITH"], "Mr Vincent van Gogh": ["Vincent", "Gogh"], "Prof. Dr. Ada Byron": ["Ada", "Byron"], "Mr Lord": ["Lord"],
}
ORDINARY = [
    "on 2024-01-02 or 01.02.2024 or 01-02-2024 or 05/06/24 at 09:30:15 and 0900-1700", "a[1::2] std::vector dead::beef 00:1a:2b:3c:4d:5e ::1",
    "version 1.20.300 of 12 345 678 at 0.123 4567890", "Mr who and Dr of Mr", "Drama Missing Mrs. x",
]


def test_spellings_beyond_the_test_tables(docs_of):
    rows = rewritten(docs_of(
        *((k, f"see {p}, now") for k, p in enumerate(PRIVATE)), *((100 + k, f"see {p}'s house") for k, p in enumerate(PERSONS)),
        *((200 + k, t) for k, t in enumerate(ORDINARY)), (300, "see Mr MacDonald, Mr O'Brien, Mr O’Brien; 555.123.4567"),
    ))
    for k, p in enumerate(PRIVATE):
        r = rows[k]
        assert p not in r.text and r.n_entities == 1 and r.n_phone == (":" not in p) and r.n_ip == (":" in p), (p, r)
        assert r.text.startswith("see ") and r.text.endswith(", now"), (p, r)
        if ":" not in p:
            assert re.sub(r"\d", "0", r.text[4:-5]) == re.sub(r"\d", "0", p), (p, r)
    assert rows[10].text == rows[11].text and rows[0].text != rows[2].text
    assert rows[300].text.split("; ")[1].replace(".", "-") == rows[0].text[4:-5]
    for k, (p, parts) in enumerate(PERSONS.items()):
        r = rows[100 + k]
        assert r.n_name == 1 and r.n_entities == 1 and not [x for x in parts if x in r.text], (p, r)
        assert r.text.endswith("'s house") and len(r.text.split()) == len(p.split()) + 2, (p, r)
    assert rows[108].text.split()[3] == "van" and rows[109].text.startswith("see Prof. Dr. ")
    one, two = re.findall(r"Mr (\w+)[,;]", rows[300].text)[1:]
    assert one == two
    for k, t in enumerate(ORDINARY):
        assert rows[200 + k].text == t, rows[200 + k]
