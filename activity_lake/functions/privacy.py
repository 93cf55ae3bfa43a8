"""Encrypted personal columns, with Spark's own AES functions.

The key becomes a literal of the plan; set ``spark.sql.redaction.string.regex``
where plans are shown to others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.functions.dates import _named

# Fixed value: what a reader sees when a value cannot be decrypted.
DECRYPT_ERROR = "Error_Decrypt"


def encrypted(c: Column | str, key: str) -> Column:
    """Base64 of the AES-GCM form; null stays null. ``key`` has 16, 24 or 32 bytes."""
    return F.base64(F.aes_encrypt(_named(c).cast("string"), F.lit(key), F.lit("GCM")))


def decrypted(c: Column | str, key: str, on_error: str = DECRYPT_ERROR) -> Column:
    """Plain text; null stays null, anything unreadable becomes ``on_error``."""
    cipher = _named(c)
    plain = F.try_aes_decrypt(F.try_to_binary(cipher, F.lit("base64")), F.lit(key), F.lit("GCM")).cast("string")
    return F.when(cipher.isNotNull(), F.coalesce(plain, F.lit(on_error)))


def encrypt(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    return df.withColumns({c: encrypted(c, key) for c in cols})


def decrypt(df: DataFrame, cols: list[str], key: str, on_error: str = DECRYPT_ERROR) -> DataFrame:
    return df.withColumns({c: decrypted(c, key, on_error) for c in cols})


def encrypt_new(actions: DataFrame, col: str, key: str) -> DataFrame:
    """Encrypt only fresh images; carried-over ones are encrypted already."""
    fresh = F.col("_merge") == "left_only"
    return actions.withColumn(col, F.when(fresh, encrypted(col, key)).otherwise(F.col(col)))


def drop_pii(df: DataFrame, cols: tuple[str, ...] = ("birthday", "entry_date", "address")) -> DataFrame:
    return df.drop(*cols)
