"""Query of the license scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridyield.llm.common import table
from gridyield.llm.license_scan import Notice, scan_licenses

#: The phrases of the contract.
BASE = [
    Notice("cc by", "cc-by", base=True), Notice("general public license", "gpl", base=True), Notice("all rights reserved", "reserved", base=True),
]
#: Own notices, with the errors they may hold.
NOTICES = [
    Notice("licensed under the apache license", "apache", 3),
    Notice("released under the mit license", "mit", 3),
    Notice("permission is hereby granted free of charge", "mit", 4),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("licensed under cc by nc", "cc-by-nc", 1),
    Notice("licensed under cc by sa", "cc-by-sa", 1),
    Notice("creative commons attribution", "creative-commons", 3),
    Notice("licensed under the gnu general public license", "gpl-notice", 4),
    Notice("mozilla public license", "mpl", 2),
    Notice("general public license", "gpl-like", 2),
    Notice("all rights reserved", "reserved-like", 2),
]


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"), BASE + NOTICES)
