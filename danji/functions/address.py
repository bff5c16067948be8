"""Address columns: "province district [sub-district]" strings and their parts."""

from pyspark.sql import Column, functions as F

from danji.constants import SEJONG, SEJONG_DISTRICT


def _word(text: Column, position: int) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(position))


def squeeze_spaces(address: Column) -> Column:
    """Collapse whitespace runs; the ends are kept, as the road key needs.

    The regular expression runs only on addresses that have a run or a space other than ' '.
    """
    unclean = address.contains("  ")
    for other in "\t\n\x0b\f\r":
        unclean = unclean | address.contains(other)
    return F.when(unclean, F.regexp_replace(address, r"\s+", " ")).otherwise(address)


def normalize_address(address: Column) -> Column:
    return F.trim(squeeze_spaces(address))


def address_word_count(address: Column) -> Column:
    return F.size(F.split(normalize_address(address), " "))


def parse_sido(address: Column) -> Column:
    return F.substring_index(normalize_address(address), " ", 1)


def parse_sigungu(address: Column) -> Column:
    """District: word 2, or words 2 and 3 when the address has four words or more."""
    text, n = normalize_address(address), address_word_count(address)
    return (
        F.when(text.startswith(SEJONG), F.lit(SEJONG_DISTRICT))
        .when(n >= 4, F.concat_ws(" ", _word(text, 2), _word(text, 3)))
        .when(n >= 2, _word(text, 2))
        .otherwise(F.lit(""))
    )


def parse_emd(address: Column) -> Column:
    """Sub-district; '' when the address stops at the district."""
    text, n = normalize_address(address), address_word_count(address)
    return (
        F.when(text.startswith(SEJONG), _word(text, 2))
        .when(n >= 4, _word(text, 4))
        .when(n >= 3, _word(text, 3))
        .otherwise(F.lit(""))
    )


def sigungu_keyword(address: Column) -> Column:
    """Keyword that finds the district in the complex register."""
    sido = parse_sido(address)
    return F.when(sido == SEJONG, sido).otherwise(parse_sigungu(address))


def _road_key(text: Column, road: Column) -> Column:
    first_two = F.when(text.contains(" "), F.substring_index(text, " ", 2)).otherwise(
        F.concat(text, F.lit(" "))
    )
    prefix = F.when(text.startswith(SEJONG), F.lit(f"{SEJONG} {SEJONG_DISTRICT}")).otherwise(first_two)
    return F.concat(prefix, F.lit(" "), road)


def road_address_key(address: Column, road: Column) -> Column:
    """Key of the coordinate table: first two address words plus the road; NULL without a road."""
    return _road_key(squeeze_spaces(address), road)


def with_road_key(df, name: str = "road_key"):
    """Add the road key of whole trades; each address is cleaned only once."""
    return (
        df.withColumn("_text", squeeze_spaces(F.col("address")))
        .withColumn(name, _road_key(F.col("_text"), F.col("road")))
        .drop("_text")
    )


def lot_address_base(lot_address: Column) -> Column:
    """Lot address without its trailing lot number."""
    return F.regexp_replace(lot_address, r"\s+\d[\d-]*$", "")


def complex_first_word(name: Column) -> Column:
    return _word(name, 1)


def volume_region_name(sido: Column, sigungu: Column) -> Column:
    return F.when(sido == SEJONG, F.lit(SEJONG)).otherwise(sigungu)


def fill_emd(emd: Column, best_emd: Column) -> Column:
    return F.coalesce(F.nullif(emd, F.lit("")), best_emd)


def may_lie_in(address: Column, *names) -> Column:
    """Cheap necessary condition: the address contains the words of one of the names of each kind.

    `names` are a name, a list of names, or None, such as a province and a district. Judged before
    an address is parsed, it spares most rows the parsing.
    """
    out = F.lit(True)
    for wanted in names:
        if not wanted:
            continue
        each = [wanted] if isinstance(wanted, str) else list(wanted)
        if SEJONG_DISTRICT in each:
            continue  # stands for the whole province and need not be written in the address
        any_name = F.lit(False)
        for name in each:
            words = F.lit(True)
            for word in name.split(" "):
                words = words & address.contains(word)
            any_name = any_name | words
        out = out & any_name
    return out


def with_region_columns(df, address: str = "address"):
    """Add sido, sigungu, emd: as the parse functions, but each address is cleaned only once.

    The expressions are kept short: a projection whose generated code grows past the JIT's limit
    for one method runs many times slower.
    """
    sejong = f"startswith(_text, '{SEJONG}')"
    # Words up to a position, and of these the last ones; the positions vary by row.
    cut = "substring_index(substring_index(_text, ' ', {end}), ' ', {back})"
    sigungu = f"""CASE WHEN {sejong} THEN '{SEJONG_DISTRICT}' WHEN _words >= 2 THEN
        {cut.format(end="IF(_words >= 4, 3, 2)", back="IF(_words >= 4, -2, -1)")} ELSE '' END"""
    place = f"CASE WHEN {sejong} THEN 2 WHEN _words >= 4 THEN 4 ELSE 3 END"
    emd = f"IF(_words >= _place, {cut.format(end='_place', back='-1')}, '')"
    return (
        df.withColumn("_text", normalize_address(F.col(address)))
        .withColumn("_words", F.size(F.split("_text", " ")))
        .withColumns(
            {
                "sido": F.substring_index("_text", " ", 1),
                "sigungu": F.expr(sigungu),
                "_place": F.expr(place),
            }
        )
        .withColumn("emd", F.expr(emd))
        .drop("_text", "_words", "_place")
    )
