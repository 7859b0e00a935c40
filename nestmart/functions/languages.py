"""Language code -> English name.

The names are a checked-in table (ISO 639-1, under 200 codes), joined on
instead of looked up row by row.  Its size is fixed, so broadcasting it is
safe and the join stays inside codegen with no Python worker; results do not
depend on the JDK build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .values import values_frame

# ISO 639-1 codes and their English names.
NAMES = (
    ("aa", "Afar"), ("ab", "Abkhazian"), ("ae", "Avestan"), ("af", "Afrikaans"),
    ("ak", "Akan"), ("am", "Amharic"), ("an", "Aragonese"), ("ar", "Arabic"),
    ("as", "Assamese"), ("av", "Avaric"), ("ay", "Aymara"), ("az", "Azerbaijani"),
    ("ba", "Bashkir"), ("be", "Belarusian"), ("bg", "Bulgarian"), ("bh", "Bihari"),
    ("bi", "Bislama"), ("bm", "Bambara"), ("bn", "Bangla"), ("bo", "Tibetan"),
    ("br", "Breton"), ("bs", "Bosnian"), ("ca", "Catalan"), ("ce", "Chechen"),
    ("ch", "Chamorro"), ("co", "Corsican"), ("cr", "Cree"), ("cs", "Czech"),
    ("cu", "Church Slavic"), ("cv", "Chuvash"), ("cy", "Welsh"), ("da", "Danish"),
    ("de", "German"), ("dv", "Divehi"), ("dz", "Dzongkha"), ("ee", "Ewe"),
    ("el", "Greek"), ("en", "English"), ("eo", "Esperanto"), ("es", "Spanish"),
    ("et", "Estonian"), ("eu", "Basque"), ("fa", "Persian"), ("ff", "Fulah"),
    ("fi", "Finnish"), ("fj", "Fijian"), ("fo", "Faroese"), ("fr", "French"),
    ("fy", "Western Frisian"), ("ga", "Irish"), ("gd", "Scottish Gaelic"), ("gl", "Galician"),
    ("gn", "Guarani"), ("gu", "Gujarati"), ("gv", "Manx"), ("ha", "Hausa"),
    ("he", "Hebrew"), ("hi", "Hindi"), ("ho", "Hiri Motu"), ("hr", "Croatian"),
    ("ht", "Haitian Creole"), ("hu", "Hungarian"), ("hy", "Armenian"), ("hz", "Herero"),
    ("ia", "Interlingua"), ("id", "Indonesian"), ("ie", "Interlingue"), ("ig", "Igbo"),
    ("ii", "Sichuan Yi"), ("ik", "Inupiaq"), ("in", "Indonesian"), ("io", "Ido"),
    ("is", "Icelandic"), ("it", "Italian"), ("iu", "Inuktitut"), ("iw", "Hebrew"),
    ("ja", "Japanese"), ("ji", "Yiddish"), ("jv", "Javanese"), ("ka", "Georgian"),
    ("kg", "Kongo"), ("ki", "Kikuyu"), ("kj", "Kuanyama"), ("kk", "Kazakh"),
    ("kl", "Kalaallisut"), ("km", "Khmer"), ("kn", "Kannada"), ("ko", "Korean"),
    ("kr", "Kanuri"), ("ks", "Kashmiri"), ("ku", "Kurdish"), ("kv", "Komi"),
    ("kw", "Cornish"), ("ky", "Kyrgyz"), ("la", "Latin"), ("lb", "Luxembourgish"),
    ("lg", "Ganda"), ("li", "Limburgish"), ("ln", "Lingala"), ("lo", "Lao"),
    ("lt", "Lithuanian"), ("lu", "Luba-Katanga"), ("lv", "Latvian"), ("mg", "Malagasy"),
    ("mh", "Marshallese"), ("mi", "Maori"), ("mk", "Macedonian"), ("ml", "Malayalam"),
    ("mn", "Mongolian"), ("mo", "Moldavian"), ("mr", "Marathi"), ("ms", "Malay"),
    ("mt", "Maltese"), ("my", "Burmese"), ("na", "Nauru"), ("nb", "Norwegian Bokmål"),
    ("nd", "North Ndebele"), ("ne", "Nepali"), ("ng", "Ndonga"), ("nl", "Dutch"),
    ("nn", "Norwegian Nynorsk"), ("no", "Norwegian"), ("nr", "South Ndebele"), ("nv", "Navajo"),
    ("ny", "Nyanja"), ("oc", "Occitan"), ("oj", "Ojibwa"), ("om", "Oromo"),
    ("or", "Odia"), ("os", "Ossetic"), ("pa", "Punjabi"), ("pi", "Pali"),
    ("pl", "Polish"), ("ps", "Pashto"), ("pt", "Portuguese"), ("qu", "Quechua"),
    ("rm", "Romansh"), ("rn", "Rundi"), ("ro", "Romanian"), ("ru", "Russian"),
    ("rw", "Kinyarwanda"), ("sa", "Sanskrit"), ("sc", "Sardinian"), ("sd", "Sindhi"),
    ("se", "Northern Sami"), ("sg", "Sango"), ("si", "Sinhala"), ("sk", "Slovak"),
    ("sl", "Slovenian"), ("sm", "Samoan"), ("sn", "Shona"), ("so", "Somali"),
    ("sq", "Albanian"), ("sr", "Serbian"), ("ss", "Swati"), ("st", "Southern Sotho"),
    ("su", "Sundanese"), ("sv", "Swedish"), ("sw", "Swahili"), ("ta", "Tamil"),
    ("te", "Telugu"), ("tg", "Tajik"), ("th", "Thai"), ("ti", "Tigrinya"),
    ("tk", "Turkmen"), ("tl", "Tagalog"), ("tn", "Tswana"), ("to", "Tongan"),
    ("tr", "Turkish"), ("ts", "Tsonga"), ("tt", "Tatar"), ("tw", "Twi"),
    ("ty", "Tahitian"), ("ug", "Uyghur"), ("uk", "Ukrainian"), ("ur", "Urdu"),
    ("uz", "Uzbek"), ("ve", "Venda"), ("vi", "Vietnamese"), ("vo", "Volapük"),
    ("wa", "Walloon"), ("wo", "Wolof"), ("xh", "Xhosa"), ("yi", "Yiddish"),
    ("yo", "Yoruba"), ("za", "Zhuang"), ("zh", "Chinese"), ("zu", "Zulu"),
)


def unknown_language(code: Column) -> Column:
    """Label for a code without a name: ``Unknown language [xx]``."""
    return F.concat(F.lit("Unknown language ["), code, F.lit("]"))


def language_names(spark: SparkSession) -> DataFrame:
    """``(code, english_name)`` of every ISO 639-1 code."""
    return values_frame(spark, NAMES, ["code", "english_name"])


def with_language_name(df: DataFrame, code_col: str, output: str = "name") -> DataFrame:
    """Add ``output``: English name of ``code_col``.

    Unknown codes get ``Unknown language [code]``; a null code keeps a null
    name (so the null-name quality rule still sees it).
    """
    names = F.broadcast(language_names(df.sparkSession)).withColumnRenamed("code", "__nm_code")
    joined = df.join(names, F.col(code_col) == F.col("__nm_code"), "left")
    name = F.when(F.col(code_col).isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.col("english_name"), unknown_language(F.col(code_col)))
    )
    cols = [name.alias(output) if c == output else F.col(c) for c in df.columns]
    if output not in df.columns:
        cols.append(name.alias(output))
    return joined.select(*cols)
