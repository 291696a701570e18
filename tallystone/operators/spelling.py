"""Path repair by known spellings: word lists, fixed substitutions, and combinations of directory and file variants."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.operators import paths

# Accented words that catalogues hold without their accents.
SPANISH = """
Rodríguez Hernández Jiménez Méndez Martínez González Sánchez Ramírez Pérez García López Gómez Díaz Vázquez Muñoz Álvarez Córdova Fernández Gutiérrez
José María Jesús Ángel Ramón Andrés Óscar Héctor Iván Rubén Adrián Sebastián Nicolás César Joaquín Martín Julián Valentín
Canción Años Niño Niña Español Todavía Cómo Qué Más También Después Líneas Yambú Versión Invitación Corazón Adiós Música Último Único
""".split()

# Contractions and clipped words that catalogues hold without their apostrophe.
CONTRACTIONS = """
Don't don't Won't won't Can't can't It's You're you're They're they're We've we've I've You've you've
I'll We'll we'll She'll He'll It'll They'll they'll I'd We'd You'd you'd She'd He'd They'd they'd I'm
What's what's That's that's Here's here's There's there's Where's where's How's how's Let's let's Who's who's
Couldn't couldn't Wouldn't wouldn't Shouldn't shouldn't Hasn't hasn't Haven't haven't Didn't didn't Doesn't doesn't
Isn't isn't Aren't aren't Wasn't wasn't Weren't weren't
Lovin' lovin' Cheatin' cheatin' Rockin' rockin' Rollin' rollin' Goin' goin' Comin' comin'
""".split()

# Substitutions in paths, in order.
SUBSTITUTIONS = [
    ("/SQURL/", "/SQÜRL/"),
    ("patricks iPhone", "patrick's iPhone"),
    ("Los Anos Maravillosos De La Canción Social Vol.Ii", "Los Años Maravillosos De La Cancion Social Vol.Ii"),
    ("José ", "Jose "),
    ("María ", "Maria "),
    ("André ", "Andre "),
    ("Café ", "Cafe "),
    ("Björk", "Bjork"),
    ("Mötley Crüe", "Motley Crue"),
    ("Beyoncé", "Beyonce"),
    ("Sinéad", "Sinead"),
    ("‘", "'"),
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("—", "-"),
    ("–", "-"),
    ("…", "..."),
]

# Fixes that are always made, and those of which only the first that applies is made where none of them was.
ALWAYS = [("patricks_to_apostrophe", *SUBSTITUTIONS[1]), ("spanish_album_fix", *SUBSTITUTIONS[2]), ("squrl_umlaut", *SUBSTITUTIONS[0])]
FIRST_OF = [("José ", "Jose "), ("María ", "Maria "), ("Jesús ", "Jesus "), ("Qué ", "Que "), ("Cómo ", "Como ")]


def without_accents(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if unicodedata.category(c) != "Mn")


def spanish() -> dict[str, str]:
    """Each word without accents, and with them: as listed, in lower and in upper case."""
    return {without_accents(form): form for word in SPANISH for form in (word, word.lower(), word.upper())}


def contractions() -> dict[str, str]:
    return {word.replace("'", ""): word for word in CONTRACTIONS}


def replace_words(name: Column, words: dict[str, str]) -> Column:
    """Whole words (runs of letters, digits and underscores) that are listed, in one pass."""
    table = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    parts = F.regexp_extract_all(name, F.lit(r"((?U)\w+|\W+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")


def replace_parts(name: Column, pairs: list[tuple[str, str]]) -> Column:
    """Every occurrence of each old text, one pair after the other."""
    listed = F.array(*(F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in pairs))
    return F.aggregate(listed, name, lambda text, p: F.replace(text, p["old"], p["new"]))


def possessive(name: Column) -> Column:
    """A last s of a word of at least four letters after a capital gets an apostrophe."""
    return F.regexp_replace(name, r"\b(\p{Lu}\p{L}{2,})s\b", "$1's")


def apostrophe_variants(name: Column) -> Column:
    """The name, with contractions, with possessives, and with both."""
    short = replace_words(name, contractions())
    return F.array_distinct(F.array(name, short, possessive(name), possessive(short)))


def substitution_variants(path: Column) -> Column:
    """Labelled spellings in order of preference: as it is, each substitution alone, all, decomposed, composed."""
    one = [F.struct(F.replace(path, F.lit(a), F.lit(b)).alias("variant"), F.lit(f"replaced_{a}_with_{b}").alias("method")) for a, b in SUBSTITUTIONS]
    labelled = lambda x, label: F.struct(x.alias("variant"), F.lit(label).alias("method"))
    rest = [labelled(replace_parts(path, SUBSTITUTIONS), "multiple_replacements"), labelled(paths.nfd(path), "nfd_normalization"), labelled(paths.nfc(path), "nfc_normalization")]
    return F.array(labelled(path, "exact"), *one, *rest)


def first_present(wanted: DataFrame, present: DataFrame, variants: Column) -> DataFrame:
    """``pth, variant, method`` of ``wanted(pth)``: the first of its labelled variants that is in ``present(pth)``; null if none."""
    spread = wanted.select("pth").distinct().select("pth", F.posexplode(variants).alias("place", "v"))
    tried = spread.select("pth", "place", F.col("v.variant").alias("variant"), F.col("v.method").alias("method")).where("place = 0 OR variant <> pth")
    found = tried.join(present.select(F.col("pth").alias("variant")).distinct(), "variant")
    best = found.groupBy("pth").agg(F.min(F.struct("place", "variant", "method")).alias("b")).select("pth", "b.variant", "b.method")
    return wanted.join(best, "pth", "left")


def known_fix(path: Column) -> tuple[Column, Column]:
    """A path after the known fixes, and the label of the last that applied; null if none did."""
    fixed, label = path, F.lit(None).cast("string")
    for name, old, new in ALWAYS:
        hit = fixed.contains(old)
        label = F.when(hit, name).otherwise(label)
        fixed = F.replace(fixed, F.lit(old), F.lit(new))
    other, named = fixed, F.lit(None).cast("string")
    for old, new in reversed(FIRST_OF):
        hit = fixed.contains(old)
        other = F.when(hit, F.replace(fixed, F.lit(old), F.lit(new))).otherwise(other)
        named = F.when(hit, f"spanish_{old}").otherwise(named)
    return F.when(label.isNull(), other).otherwise(fixed), F.coalesce(label, named)


def by_accents(wanted: DataFrame, disk: DataFrame) -> DataFrame:
    """``parent, db_name`` with the first of: the same path; all accents off; a file of the same folder that differs in
    accents; the folder without accents; both without. ``disk(parent, name)``; ``found`` is a path."""
    parent, name = F.col("parent"), F.col("db_name")
    plain_parent, plain_name = paths.strip_accents(parent), paths.strip_accents(name)
    rows = wanted.select("parent", "db_name", plain_parent.alias("pp"), plain_name.alias("pn")).distinct()
    there = disk.select("parent", "name").distinct()
    exact = lambda p, n, tag: there.select(F.col("parent").alias(p), F.col("name").alias(n), F.lit(True).alias(tag))
    folded = there.groupBy("parent", paths.strip_accents("name").alias("pn")).agg(F.min("name").alias("near"))
    rows = rows.join(exact("parent", "db_name", "e"), ["parent", "db_name"], "left").join(exact("pp", "pn", "f"), ["pp", "pn"], "left")
    rows = rows.join(folded, ["parent", "pn"], "left").join(exact("pp", "db_name", "g"), ["pp", "db_name"], "left")
    at = lambda p, n: F.concat_ws("/", p, n)
    steps = [("exact", F.col("e"), at("parent", "db_name")), ("no_accent_full", F.col("f"), at("pp", "pn")), ("no_accent_filename", F.col("near").isNotNull(), at("parent", "near")), ("no_accent_parent", F.col("g"), at("pp", "db_name"))]
    found, method = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, test, path in reversed(steps):
        found, method = F.when(test, path).otherwise(found), F.when(test, label).otherwise(method)
    return rows.select("parent", "db_name", found.alias("found"), method.alias("method"))


def combinations(wanted: DataFrame, disk: DataFrame) -> DataFrame:
    """``parent, db_name`` with the first pair of a folder's and a file's spelling that ``disk(parent, name)`` has."""
    keyed = lambda c, tag: F.posexplode(paths.variants(F.col(c))).alias(f"{tag}_at", tag)
    rows = wanted.select("parent", "db_name").distinct()
    rows = rows.select("parent", "db_name", keyed("parent", "p")).select("*", keyed("db_name", "n"))
    there = disk.select(F.col("parent").alias("p"), F.col("name").alias("n")).distinct()
    best = rows.join(there, ["p", "n"]).groupBy("parent", "db_name").agg(F.min(F.struct("p_at", "n_at", "p", "n")).alias("b"))
    return best.select("parent", "db_name", F.concat_ws("/", "b.p", "b.n").alias("found"))


def backup_folder(path: Column) -> Column:
    """The path down to its first part that starts with ``back-``; null if there is none but as the first."""
    return F.when(path.contains("/back-"), F.regexp_extract(path, r"^((?:(?!back-)[^/]*/)*back-[^/]*)", 1))


def backup_class(missing: DataFrame, backups: DataFrame) -> DataFrame:
    """Missing paths by whether they lie in a backup of ``backups(folder)``, in one that is gone, or in none."""
    rows = missing.withColumn("folder", backup_folder(F.col("pth")))
    known = backups.select("folder", F.lit(True).alias("_k")).dropDuplicates()
    kind = F.when(F.col("folder").isNull(), "no_backup").when(F.col("_k"), "existing_backup").otherwise("deleted_backup")
    return rows.join(known, "folder", "left").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def differing_code_points(a: Column, b: Column) -> Column:
    """Places where two names differ, with both code points as ``U+XXXX`` (null behind the shorter one's end)."""
    letter = lambda x, i: F.when(i < F.char_length(x), F.substring(x, i + 1, F.lit(1)))
    code = lambda x, i: F.when(letter(x, i).isNotNull(), F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(letter(x, i))), 4, "0")))
    places = F.sequence(F.lit(0), F.greatest(F.char_length(a), F.char_length(b), F.lit(1)) - 1)
    return F.filter(F.transform(places, lambda i: F.struct(i.alias("place"), code(a, i).alias("left"), code(b, i).alias("right"))), lambda s: ~s["left"].eqNullSafe(s["right"]))
