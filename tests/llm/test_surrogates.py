import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lotbook.llm import surrogates
from tests.llm.fixtures import by_id, documents, prose

PLANTED = ["ann.lee@mail4.example.com", "+1 (961) 555-6946", "4040549990366437", "4012 8888 8888 1881", "76.133.12.197",
           "10.1.2.3", "078-05-1120", "DE89 3704 0044 0532 0130 00", "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"]


def replaced(spark, texts, key="k", **options):
    frame = documents(spark, [(i, t, "s") for i, t in enumerate(texts)], extra=("n_surrogates", "_row", "_pieces2"))
    return by_id(surrogates.replace_personal_data(frame, key, **options))


def test_planted_values_are_gone_and_keep_their_form(spark):
    found = replaced(spark, [f"before {p} after" for p in PLANTED] + [f"token = \"{PLANTED[-1].upper()}\"!!"])
    for i, original in enumerate(PLANTED):
        text = found[i]["text"]
        new = text.removeprefix("before ").removesuffix(" after")
        assert found[i]["n_surrogates"] == 1 and new != original and text.startswith("before ")
        if i not in (4, 5):
            assert re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "0", re.sub("[a-f0-9]{40}", "h" * 40, new))) == re.sub(
                r"[a-z]", "a", re.sub(r"[0-9]", "0", re.sub("[a-f0-9]{40}", "h" * 40, original)))
    assert surrogates._luhn(found[3]["text"][7:-6].replace(" ", "")) == 0
    assert surrogates._iban_rest(found[7]["text"][7:-6].replace(" ", "")) == 1
    assert found[5]["text"].startswith("before 10.")
    # One secret in two spellings.
    assert found[len(PLANTED)]["text"] == f'token = "{found[8]["text"][7:-6].upper()}"!!'


def test_names_follow_gender_script_and_coreference(spark):
    found = replaced(spark, ["Mrs. Ann Lee met Mr. Bob Lee. Mrs. Lee left.", "господин Иван Петров и госпожа Анна Петрова"])
    names = re.findall(r"Mrs?\. ((?:[A-Z]\w+ ?)+)", found[0]["text"])
    (ann, lee), (bob, lee2), (lee3,) = (n.split() for n in names)
    assert lee == lee2 == lee3 != "Lee" and ann.endswith("a") and not bob.endswith("a")
    assert re.fullmatch(r"господин [А-Я][а-я]+ [А-Я][а-я]+ и госпожа [А-Я][а-я]+а [А-Я][а-я]+", found[1]["text"])


def test_clean_and_awkward_texts_stay(spark):
    draw = random.Random(6)
    texts = [None, "", " ", "CC BY-NC 4.0.", "version 3.0 of 12 items", "a@b", "1.2.3", "12:30 on 2024-05-06",
             prose(draw, 300), "Licensed under the Apache License, Version 2.0."]
    found = replaced(spark, texts)
    assert [found[i]["text"] for i in range(len(texts))] == texts
    assert all(row["n_surrogates"] == 0 for row in found.values())


def test_equal_values_agree_and_different_ones_stay_apart(spark):
    addresses = [f"10.0.{i // 250}.{i % 250 + 1}" for i in range(600)]
    found = replaced(spark, [f"{a} and {a}" for a in addresses] + ["007.5 " * 3 + addresses[3]] * 2)
    pairs = [found[i]["text"].split(" and ") for i in range(600)]
    assert all(a == b for a, b in pairs)
    made = {a for a, _ in pairs}
    assert len(made) == 600 and not made & set(addresses)
    assert found[600]["text"] == found[601]["text"] == "007.5 " * 3 + pairs[3][0]


def test_collisions_are_drawn_again(spark, monkeypatch):
    values = spark.createDataFrame([("ssn", f"{i:09d}") for i in range(30)], "kind string, value string")

    def narrow(frame, key, attempt):
        # Ten values to draw from at first, some of them values of the corpus.
        room = F.lit(10) if attempt < 2 else F.lit(10**9)
        drawn = F.lpad(F.pmod(F.xxhash64("value", F.lit(attempt)), room).cast("string"), 9, "0")
        return frame.withColumn("surrogate", drawn)

    monkeypatch.setattr(surrogates, "_drawn", narrow)
    rows = surrogates.distinct_surrogates(values, b"k").collect()
    assert len(rows) == len({r["surrogate"] for r in rows}) == 30
    assert not {r["surrogate"] for r in rows} & {r["value"] for r in rows}


def test_entities_without_a_digit_are_found(spark):
    keys = ["api_key", "API-KEY", "access_key", "AccessKey", "secret", "Token", "password", "passwd", "PWD"]
    texts = [f"{k}: correct-horse-battery" for k in keys] + [
        "abcdefabcdef" * 3, "AKIA" + "ABCDEFGH" * 2, *[f"gh{c}_" + "abcDEF" * 6 for c in "pousr"], "sk-" + "abcDEF" * 4,
        "ann@example.com", *[f"{h} Lee" for h in "Mr Herr Herrn Monsieur Sr Mrs Ms Miss Frau Madame Mme Mlle".split()],
        *[f"{h} Lee" for h in "Señor Señora Señorita Sra Srta".split()],
        *[f"{h} Петров" for h in "господин господина господину г-н госпожа госпоже госпожу г-жа".split()]]
    assert not any(c.isdigit() for t in texts for c in t)
    found = replaced(spark, texts)
    assert [found[i]["n_surrogates"] for i in range(len(texts))] == [1] * len(texts)
    assert all(found[i]["text"] != t for i, t in enumerate(texts))


def test_long_entities_are_replaced_to_their_end(spark):
    draw = random.Random(9)
    long = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789") for _ in range(1200))
    wanted = {
        f"token = {long}": [long], f"secret: {long[:40]}.{long[40:700]}.{long[700:743]}": [f"{long[:40]}.{long[40:700]}.{long[700:743]}"],
        "password: correct-horse.battery. Then": ["correct-horse.battery"], "password: ............": [],
        "a1b2c3d4" * 17: ["a1b2c3d4" * 17], "ghp_" + long[:100]: ["ghp_" + long[:100]], "sk-" + long[:164]: ["sk-" + long[:164]],
        "Mr. Juan Carlos Maria Garcia Lopez left": ["Juan", "Carlos", "Maria", "Garcia", "Lopez"],
        f"to .{'ab.' * 30}c@example.com": [f"{'ab.' * 30}c@example.com"], f"{'q' * 90}@{'z' * 70}.com": [f"{'q' * 90}@{'z' * 70}.com"],
        "ann@aa.bb.cc.dd.ee.ff.gg.hh.example.com": ["ann@aa.bb.cc.dd.ee.ff.gg.hh.example.com"],
        "token: annabel.lee.jones@example.com": ["annabel.lee.jones@example.com"],
        "+1 (961) 555-6946.ann@example.com": ["+1 (961) 555-6946", "ann@example.com"],
    }
    for text, parts in wanted.items():
        assert [text[start:end] for start, end, _, _ in surrogates.entities(text)] == parts
    found = replaced(spark, list(wanted))
    for i, (text, parts) in enumerate(wanted.items()):
        assert found[i]["n_surrogates"] == len(parts) and (found[i]["text"] != text) == bool(parts)
        assert not any(part in found[i]["text"] for part in parts)


@pytest.mark.parametrize("run", ["a.", "a-", "--", "a1", "a@", "x@b.", "12", "+1", "token:", "token: ..", "Mr. "])
def test_long_runs_take_linear_time(run):
    start = time.process_time()
    list(surrogates.entities(run * 100_000))
    assert time.process_time() - start < 20


def test_key_decides_and_reruns_agree(spark):
    text = "mail ann@example.com now"
    one, same, other = (replaced(spark, [text, text], key=k) for k in ("a", "a", "b"))
    assert one[0]["text"] == same[0]["text"] == one[1]["text"] != other[0]["text"]
    assert replaced(spark, []) == {}


def test_columns_named_like_helpers_keep_their_values(spark):
    names = ("_row", "_pieces", "_news", "_place", "row", "pieces", "news", "place", "k0", "n", "slice")
    frame = documents(spark, [(i, t, "s") for i, t in enumerate(["mail ann@example.com", "clean", None])], extra=names)
    found = surrogates.replace_personal_data(frame, "k")
    assert found.columns == [*frame.columns, "n_surrogates"]
    assert all(row[name] == "own" for row in found.collect() for name in names)


def test_a_full_space_is_left_for_a_wider_one(spark):
    """Every private address of a block is in the corpus: all get a surrogate of their own outside it."""
    addresses = [f"192.168.{a}.{b}" for a in range(256) for b in range(256)]
    found = replaced(spark, [" ".join(addresses[i : i + 256]) for i in range(0, 65536, 256)])
    made = [new for i in range(256) for new in found[i]["text"].split()]
    assert len(made) == len(set(made)) == 65536 and not set(made) & set(addresses)


def test_every_kind_widens_without_end():
    values = {"email": "a@b.de", "ip": "127.0.0.1", "ip6": "fe80::1", "card": "4040549990366437", "phone": "+1234567",
              "iban": "DE89370400440532013000", "secret": "a..........b", "ssn": "078051120", "surname": "lee",
              "given_f": "ann"}
    for kind, value in values.items():
        drawn = [len({surrogates.surrogate(kind, value, str(k).encode(), attempt) for k in range(400)})
                 for attempt in (0, 24)]
        assert drawn[1] == 400 >= drawn[0], kind


def test_distinctness_and_coreference_equal_brute_force(spark):
    """Equal values get one surrogate wherever they stand, different ones different ones, none of them a value found."""
    draw = random.Random(31)
    makers = [
        lambda: f"10.{draw.randint(0, 1)}.0.{draw.randint(0, 30)}", lambda: f"{draw.choice('abc')}{draw.randint(0, 9)}@x.org",
        lambda: f"+49 30 {draw.randint(1000, 1030)}", lambda: f"{draw.randint(100, 120)}-{draw.randint(10, 12)}-1234",
        lambda: f"fe80::{draw.randint(0, 20):x}", lambda: "Mr. " + draw.choice(["Lee", "Ray", "Kim"])]
    texts = ["; ".join(draw.choice(makers)() for _ in range(draw.randint(1, 8))) for _ in range(300)]
    texts += ["10.0.0.5; " * 40] * 60  # one value on a large share of the rows
    found = replaced(spark, texts)
    mapping = {}
    for i, text in enumerate(texts):
        before, after = ([(k, v) for _, _, k, v in surrogates.entities(t)] for t in (text, found[i]["text"]))
        assert len(before) == len(after) == found[i]["n_surrogates"]
        for old, new in zip(before, after, strict=True):
            assert mapping.setdefault(old, new) == new
    values = list(mapping.values())
    assert len(set(values)) == len(values) and not set(values) & set(mapping)


def test_further_kinds(spark):
    texts = ["see https://ann:pa55-w0rd@example.com/x", "Authorization: Bearer abcDEF0123456789.xyz", "at 2001:db8::8a2e:370:7334",
             "at 2001:0db8:85a3:0000:0000:8a2e:0370:7334.", "std::cout 12:30:45 a::b", "Bearer of good news all around"]
    found = replaced(spark, texts)
    assert [found[i]["n_surrogates"] for i in range(6)] == [1, 1, 1, 1, 0, 0]
    for i, secret in enumerate(["pa55-w0rd", "abcDEF0123456789.xyz", "8a2e:370:7334", "8a2e:0370:7334"]):
        assert secret not in found[i]["text"]
