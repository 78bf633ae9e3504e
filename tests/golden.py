"""The 18 reference rows of the versioned risk table, in the columns the queries use."""

import datetime

from landgate.schemas import RISK

# Fixed values. (type, identifier, scenario, year, percentile, class, metric, value, proxied, region)
ROWS = """
ISIN|US0378331005|RCP 8.5|2050|P50|EQUITY|Physical Risk Score|0.342|N|North America
ISIN|US0378331005|RCP 8.5|2050|P95|EQUITY|Physical Risk Score|0.587|N|North America
ISIN|US0378331005|RCP 4.5|2050|P50|EQUITY|Physical Risk Score|0.198|N|North America
ISIN|US5949181045|RCP 8.5|2050|P50|EQUITY|Physical Risk Score|0.412|N|North America
ISIN|US5949181045|RCP 8.5|2030|P50|EQUITY|Physical Risk Score|0.285|N|North America
CUSIP|912828ZT6|RCP 8.5|2050|P50|FIXED_INCOME|Flood Risk Score|0.125|N|North America
CUSIP|912828ZT6|RCP 8.5|2050|P50|FIXED_INCOME|Wildfire Risk Score|0.067|N|North America
CUSIP|06051GJE5|RCP 8.5|2050|P50|FIXED_INCOME|Physical Risk Score|0.521|Y|Europe
TICKER|BGSAX|RCP 8.5|2050|P50|MULTI_ASSET|Physical Risk Score|0.298|N|Global
TICKER|BGSAX|RCP 8.5|2100|P50|MULTI_ASSET|Physical Risk Score|0.645|N|Global
TICKER|MSILX|SSP2-4.5|2050|P50|EQUITY|Heat Stress Score|0.456|N|Asia Pacific
SOVEREIGN|NLD|RCP 8.5|2050|P50|SOVEREIGN|Sea Level Rise Score|0.782|N|Europe
SOVEREIGN|NLD|RCP 8.5|2050|P50|SOVEREIGN|Flood Risk Score|0.891|N|Europe
SOVEREIGN|USA|RCP 8.5|2050|P50|SOVEREIGN|Wildfire Risk Score|0.534|N|North America
ISIN|US0378331005|RCP 8.5|2050|P50|EQUITY|Physical Risk Score|0.335|N|North America
ISIN|JP3435000009|RCP 8.5|2050|P50|EQUITY|Typhoon Risk Score|0.672|N|Asia Pacific
ISIN|JP3435000009|RCP 8.5|2050|P50|EQUITY|Physical Risk Score|0.558|N|Asia Pacific
ISIN|DE0007164600|RCP 8.5|2050|P50|EQUITY|Physical Risk Score|0.389|Y|Europe
"""
EXPIRED = 15  # row number of the version that was replaced

COLUMNS = (
    "identifier_type", "identifier", "scenario_name", "scenario_year", "scenario_percentile",
    "asset_class", "metric_name", "metric_value", "is_proxied", "region",
)


def golden(spark):
    """All 33 columns; those no query looks at are NULL."""
    rows = []
    for n, line in enumerate(ROWS.strip().splitlines(), 1):
        row = dict(zip(COLUMNS, line.split("|")))
        month = 3 if n == EXPIRED else 4
        row["metric_value"] = float(row["metric_value"])
        row["metric_name_internal"] = (
            row["metric_name"].lower().replace("physical", "phys").replace(" ", "_")
        )
        row["version"] = "v3.1" if n == EXPIRED else "v3.2"
        row["as_of_date"] = row["risk_date"] = datetime.date(2026, month, 15)
        row["effective_start_date"] = datetime.date(2026, month, 1)
        row["effective_end_date"] = (
            datetime.date(2026, 3, 31) if n == EXPIRED else datetime.date(9999, 12, 31)
        )
        row["updated_dts"] = datetime.datetime(2026, month, 15, 8, 30)
        row["created_dts"] = datetime.datetime(2026, month, 1, 10, 0)
        row["status"] = "ACTIVE"
        row["file_name"] = f"risk_2026{month:02d}15.parquet"
        rows.append(tuple(row.get(f.name) for f in RISK.fields))
    return spark.createDataFrame(rows, RISK)
