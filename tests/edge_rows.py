"""Hand-made input tables in which each row stands for one rule."""

from datetime import date

from ledgerline import schemas

SOURCE = "DELINQUENCY"

ROWS = {
    "load_batches": [
        # an older period loses, despite its larger file name
        (101, 50, date(2024, 1, 31), None, 8, "z_jan.csv"),
        # a tie: one batch gives the file name, the other the batch id
        (102, 50, date(2024, 2, 29), None, 8, "y_feb.csv"),
        (103, 50, date(2024, 2, 29), None, 8, "a_feb.csv"),
        # cancelled: not reported, but refreshed
        (104, 50, date(2024, 3, 31), date(2024, 4, 2), 8, "m_mar.csv"),
        # another source type
        (105, 50, date(2024, 5, 31), None, 3, "other.csv"),
        # no period
        (106, 50, None, None, 8, "null.csv"),
        # an entity without any period
        (201, 60, None, None, 8, "n60.csv"),
        # no balances
        (301, 70, date(2024, 1, 31), None, 8, "g70.csv"),
        # inactive entity
        (401, 80, date(2024, 1, 31), None, 8, "h80.csv"),
        # only a balance without period
        (501, 90, date(2024, 1, 31), None, 8, "k90.csv"),
        # a batch id shared with another source type
        (102, 55, date(2023, 12, 31), None, 3, "dup.csv"),
    ],
    "general_balances": [
        (103, 1, 1, date(2024, 2, 29)),
        (103, 2, 1, date(2024, 3, 31)),
        (102, 1, 1, date(2024, 6, 30)),
        (104, 3, 1, date(2024, 3, 15)),
        (401, 4, 1, date(2024, 1, 31)),
        (501, 5, 1, None),
        (101, 6, 1, date(2024, 1, 31)),
        (101, 6, 2, date(2024, 12, 31)),
    ],
    "microfinance_balances": [
        (1, 1, 50),
        # of another entity than the batch's
        (2, 1, 99),
        (3, 1, 50),
        # twice
        (6, 1, 50),
        (6, 1, 50),
        (4, 1, 80),
        (5, 1, 90),
    ],
    "entity_sources": [
        (50, "Caja A", 1),
        (50, "Caja A", 1),
        (50, "Caja A bis", 1),
        (50, "Caja old", 0),
        (80, "Off", 0),
        (90, "Null GP", 1),
        (70, "No bal", 1),
        (60, "All null", 1),
    ],
    "source_codes": [(SOURCE, 8)],
}

SCHEMAS = {
    "load_batches": schemas.LOAD_BATCHES,
    "general_balances": schemas.GENERAL_BALANCES,
    "microfinance_balances": schemas.MICROFINANCE_BALANCES,
    "entity_sources": schemas.ENTITY_SOURCES,
    "source_codes": schemas.SOURCE_CODES,
}

LATEST = [
    (50, 103, "y_feb.csv"),
    (70, 301, "g70.csv"),
    (80, 401, "h80.csv"),
    (90, 501, "k90.csv"),
]

REPORT = [
    (50, "Caja A", date(2024, 3, 31), "y_feb.csv", 103),
    (50, "Caja A bis", date(2024, 3, 31), "y_feb.csv", 103),
    (90, "Null GP", None, "k90.csv", 501),
]

REFRESH_SOURCE = [
    (101, date(2024, 1, 31)),
    (102, date(2024, 6, 30)),
    (103, date(2024, 2, 29)),
    (104, date(2024, 3, 15)),
    (106, None),
    (201, None),
    (301, None),
    (401, date(2024, 1, 31)),
    (501, None),
]

# By (batch, entity).
REFRESHED_PERIODS = {
    (101, 50): date(2024, 1, 31),
    (102, 50): date(2024, 6, 30),
    (102, 55): date(2024, 6, 30),
    (103, 50): date(2024, 2, 29),
    (104, 50): date(2024, 3, 15),
    (105, 50): date(2024, 5, 31),
    (106, 50): None,
    (201, 60): None,
    (301, 70): None,
    (401, 80): date(2024, 1, 31),
    (501, 90): None,
}

REPORT_AFTER_REFRESH = [
    (50, "Caja A", date(2024, 6, 30), "y_feb.csv", 102),
    (50, "Caja A bis", date(2024, 6, 30), "y_feb.csv", 102),
]
