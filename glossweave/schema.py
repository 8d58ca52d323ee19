"""Declared schemas of the record model."""

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType


def struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


TEXT, INT, LONG, TEXTS = StringType(), IntegerType(), LongType(), ArrayType(StringType())
SPAN = struct(a=INT, b=INT)
LINE = struct(page=INT, k=INT, text=TEXT, underlines=ArrayType(SPAN))
CORRECTION = struct(page=INT, line=INT, col=INT, content=TEXT, layer=INT, seq=LONG)
SUB = struct(loko=TEXT, fako=TEXT, texto=TEXT, texto_k=TEXT, kodo=TEXT, lingui=TEXTS)
RECORD = struct(
    vedetto=TEXT, fako=TEXT, senci=TEXTS, strukt=ArrayType(struct(texto=TEXT, texto_k=TEXT, sub=ArrayType(SUB))), noti=TEXTS, sublineita=TEXTS, kursiva=TEXTS,
    dubinda=TEXTS, latina=TEXTS, simbolo=TEXT, kodo=TEXT, lingui=TEXTS, pagino=INT, ligno=INT, image=INT, citita=BooleanType(), texto=TEXT, texto_brut=TEXT,
    korektigita=INT, drapeli=TEXTS,
)
COMPACT = struct(v=TEXT, f=TEXT, l=TEXTS, b=ArrayType(struct(t=TEXT, u=ArrayType(struct(q=TEXT, k=TEXT, t=TEXT, n=TEXTS)))), r=TEXTS, n=TEXTS, p=INT, g=INT, d=TEXTS, y=TEXT, c=INT)
