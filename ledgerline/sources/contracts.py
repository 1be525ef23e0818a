"""Schema contracts for landed sources (data model; S4, J3, S18)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)


def positional_schema(width: int, names: dict[int, tuple[str, object]]) -> StructType:
    """Contract for a headerless file: ``width`` columns, the named positions
    typed, every other position read as text under a placeholder name."""
    fields = []
    for i in range(width):
        if i in names:
            n, t = names[i]
            fields.append(StructField(n, t, True))
        else:
            fields.append(StructField(f"_c{i}", StringType(), True))
    return StructType(fields)


# Up-sell CSV (headerless, latin-1): the first seven positions are kept.
UPSELL_CSV = StructType([
    StructField("cuenta", LongType()), StructField("ot", LongType()),
    StructField("service_code", StringType()), StructField("monthly_rental_charge", DoubleType()),
    StructField("renta_mes_anterior", DoubleType()), StructField("cod_servicio_anterior", StringType()),
    StructField("tipo_cambio", StringType()),
])

# Sales/purchase CSV (headerless, >= 18 columns): used positions.
SALES_CSV_POSITIONS = {
    0: ("cuenta", LongType()), 1: ("ot", LongType()), 2: ("anio_1", StringType()),
    3: ("anio_2", StringType()), 4: ("dia", StringType()), 5: ("mes", StringType()),
    11: ("codigo_servicio_ad", StringType()), 13: ("cantidad", StringType()),
    15: ("plazo", StringType()), 16: ("valor_total", StringType()), 17: ("valor", StringType()),
}
