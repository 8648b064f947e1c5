from pyspark.sql import functions as F

from brandlens.functions import labels, numbers, text


def test_presence_with_and_without_franchise(values):
    rows = values(numbers.presence_pair, ["82 и 20 франчайзинговых", "21", "15 Франчайзинговых", "франчайзинг", "нет", None,
                                          "99999999999999999999 и 3"])
    assert [(r.own, r.franchise) for r in rows] == [
        (82.0, 20.0), (21.0, 0.0), (0.0, 15.0), (None, None), (None, None), (None, None), (1e20, 0.0)]


def test_region_count(values):
    assert values(labels.item_count, ["Москва; Санкт-Петербург; ; Казань", "", None, "а;а", "\t;  "]) == [3, 0, 0, 2, 0]


def test_clean_name(values):
    assert values(text.clean_name, ["ООО «Ромашка» ромашка", "  Ёлка-ИП 24 ", None, "zao Zao", "ипотека ип"]) == [
        "ромашка", "ёлка 24", "", "", "ипотека"]
    assert values(lambda c: text.clean_name(c, yo=False), ["ёлка"]) == ["лка"]


def test_country(values):
    given = [" Росия ", "USA", "Беларусь!", "***", None, "Côte  d'Ivoire ", "республика   беларусь", ""]
    assert values(text.country, given) == ["Россия", "США", "Республика Беларусь", "Неизвестно", "Неизвестно",
                                           "Côte  d'Ivoire", "Республика Беларусь", "Неизвестно"]
    assert values(text.country_key, ["Côte  d'Ivoire", None, "A_b, c-d"]) == ["côte divoire", "", "a_b, c-d"]


def test_domain(values):
    assert values(text.domain, ["  Одежда \t и  обувь ", "", None, " "]) == [
        "Одежда и обувь", "Неизвестно", "Неизвестно", "Неизвестно"]
    assert values(text.domain_key, ["Кафе, ресторан (b2b)", None]) == ["кафе ресторан b2b", ""]


def test_price_labels(values):
    given = ["Средний, дисконт:средний", " ; ,", None, "люкс / премиум;​ниже среднего"]
    assert values(labels.normal_labels, given) == [
        "средний;дисконт", "неизвестно", "неизвестно", "люкс / премиум;ниже среднего"]
    pairs = values(labels.split_labels, ["средний;неизвестно", "чужой;дисконт", None])
    assert [(p.known, p.unexpected) for p in pairs] == [(["средний"], []), (["дисконт"], ["чужой"]), ([], [])]


def test_labels_text(values):
    flags = values(lambda c: labels.indicators_text(labels.indicators(labels.known_labels(c))),
                   ["люкс / премиум;дисконт", "неизвестно"])
    assert flags == ["дисконт; люкс / премиум", "неизвестно"]


def test_to_number(values):
    given = ["12", " 1.5e3 ", "abc", "1d", "nan", "Infinity", "1_000", "", None, "-.5", "1e999", "0x10"]
    assert values(numbers.to_number, given) == [12.0, 1500.0, None, None, None, None, None, None, None, -0.5, None, None]


def test_text_measures(values):
    given = ["Основана в 1998 году, 2012г. и 2012", "", None, "  a b\n", "x1899y 18991 1750 2099"]
    assert values(text.year_mentions, given) == [2, 0, 0, 0, 1]
    assert values(text.has_digit, given) == [1, 0, 0, 0, 1]
    assert values(text.word_count, given) == [7, 0, 0, 2, 4]
    assert values(text.char_count, given) == [35, 0, 0, 6, 22]
    assert values(text.empty_flag, given + [" \t\x1c"]) == [0, 1, 1, 0, 0, 1]
    assert values(text.char_count, ["😀é"]) == [2]


def test_numbers(values):
    assert values(numbers.decade, [1999.0, 2000.0, None, 1850.5], "double") == [1990, 2000, None, 1850]
    assert values(numbers.clip, [1700.0, 2090.0, 1900.5, None], "double") == [1850.0, 2025.0, 1900.5, None]
    assert values(numbers.round_half_even, [1998.5, 1999.5, None], "double") == [1998, 2000, None]
    assert values(numbers.finite, [float("nan"), float("inf"), 1.0], "double") == [None, None, 1.0]


def test_missing_text(values):
    assert values(text.missing_text, [" NaN ", "<NA>", None, "", "x", "none"]) == [True, True, True, True, False, True]


def test_hash_matches_md5(spark):
    import hashlib
    got = spark.range(1).select(numbers.hash32(F.lit("1|42")).alias("h")).first().h
    assert got == int(hashlib.md5(b"1|42").hexdigest()[:8], 16)
