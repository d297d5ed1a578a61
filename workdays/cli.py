"""Command line: the reference's menu options as subcommands.

  consolidar   a month of daily exports -> monthly ';' load files (menu option 2)
  cargar       delimited load files or a month's daily exports -> calls table
               (insert-ignore, quarantine)
  informe      days per agent, per agent with totals, per group (R1-R3, R5)
  media        mean handling time per agent (R4)
  asistencia   placeholder rows for agents present without calls (X2)
  cobertura    programme-days with no data (X1)

Tables are parquet folders with the schemas of ``workdays.model``. Results are
written to ``--salida``; ``--mostrar N`` also prints the first N rows.

Example:
  spark-submit -m workdays.cli informe --llamadas /data/llamadas --agentes /data/agentes \\
      --grupos /data/grupos --programas /data/programas --periodo 2022-11 --programa 17 \\
      --tipo total --salida /out/dias_total
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .functions.present import presentar
from .model import Period
from .plans import attendance, coverage, ingest, reports
from .sources import files, sinks


def _leer(spark: SparkSession, ruta: str | None) -> DataFrame | None:
    return spark.read.parquet(ruta) if ruta else None


def _escribir(df: DataFrame, args: argparse.Namespace) -> None:
    if args.mostrar:
        df.show(args.mostrar, truncate=False)
    if args.salida:
        w = df.write.mode("overwrite")
        if args.formato == "csv":
            w.option("header", "true").option("sep", ";").csv(args.salida)
        else:
            w.parquet(args.salida)


def _periodo(texto: str | None) -> Period | None:
    return Period.parse(texto) if texto else None


def _comunes(p: argparse.ArgumentParser) -> None:
    p.add_argument("--salida", help="output folder")
    p.add_argument("--formato", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--mostrar", type=int, default=0, help="print the first N rows")


def construir() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="workdays")
    sub = ap.add_subparsers(dest="orden", required=True)

    c = sub.add_parser("cargar", help="load delimited files into the calls table")
    c.add_argument("--origen", required=True, help="folder with 'YYYYMM [SALIDA ]to_access.csv' files")
    c.add_argument(
        "--exportaciones",
        metavar="YYYY-MM",
        help="read that month's daily 'YYYYMMDD [SALIDA ]multioption_monitor_*' exports instead",
    )
    c.add_argument("--ext", default="csv", help="extension of the daily exports")
    c.add_argument("--carpetas", action="store_true", help="origin is a 'consolidar' output (salida=/anio_mes= folders)")
    c.add_argument("--destino", required=True, help="calls table folder (parquet, by anio_mes)")
    c.add_argument("--salida-nombre", default="", help="output-name part of the file names")
    c.add_argument("--programa", type=int, help="programme id for every row")
    c.add_argument("--programas", help="programmes table, to tag rows by file name")
    c.add_argument("--cuarentena", help="folder for rows that cannot be read")
    c.add_argument("--encoding", default="UTF-8")
    c.add_argument("--sep", default=";")

    k = sub.add_parser("consolidar", help="a month of daily exports -> monthly load files")
    k.add_argument("--origen", required=True, help="folder with 'YYYYMMDD [SALIDA ]multioption_monitor_*' exports")
    k.add_argument("--periodo", required=True, help="YYYY-MM")
    k.add_argument("--salida-nombre", default="")
    k.add_argument("--destino", required=True, help="folder of 'YYYYMM [SALIDA ]to_access.csv' load files, which 'cargar' finds")
    k.add_argument("--carpetas", action="store_true", help="write salida=/anio_mes= folders instead of named files")
    k.add_argument("--ext", default="csv")
    k.add_argument("--encoding", default="UTF-8")
    k.add_argument("--sep", default=";")

    i = sub.add_parser("informe", help="days worked and billing")
    i.add_argument("--tipo", choices=["agente", "total", "grupo", "todos"], default="total",
                   help="'todos': the three reports from one reading of the calls, in salida/{agente,total,grupo}")
    for t in ("llamadas", "agentes", "grupos", "programas"):
        i.add_argument(f"--{t}", required=t == "llamadas")
    i.add_argument("--reglas", help="exclusion rules table (programa_id, anio_mes, log_name)")
    i.add_argument("--periodo", help="YYYY-MM; all months when absent")
    i.add_argument("--programa", type=int)
    i.add_argument("--sin-marcadores", action="store_true", help="ignore attendance placeholder rows")
    i.add_argument("--presentar", action="store_true", help="money as Spanish text, total markers")
    i.add_argument("--titulos", action="store_true", help="with --presentar: display titles as column names")
    _comunes(i)

    m = sub.add_parser("media", help="mean handling time per agent")
    m.add_argument("--llamadas", required=True)
    m.add_argument("--periodo")
    m.add_argument("--programa", type=int)
    m.add_argument("--mensual", action="store_true")
    m.add_argument("--sin-marcadores", action="store_true")
    _comunes(m)

    rq = sub.add_parser("reprocesar", help="replay quarantined rows after the programmes changed")
    rq.add_argument("--destino", required=True, help="calls table folder")
    rq.add_argument("--cuarentena", required=True)
    rq.add_argument("--programas", required=True)

    a = sub.add_parser("asistencia", help="register agents present without calls")
    for t in ("llamadas", "agentes", "programas"):
        a.add_argument(f"--{t}", required=t != "llamadas")
    a.add_argument("--fecha", required=True, help="YYYY-MM-DD")
    a.add_argument("--programa", type=int, required=True)
    a.add_argument("--agente", action="append", default=[], help="log_name; repeat for several")
    a.add_argument("--destino", help="calls table to load the rows into (insert-ignore)")
    _comunes(a)

    v = sub.add_parser("cobertura", help="programme-days without data")
    v.add_argument("--llamadas", required=True)
    v.add_argument("--programas")
    v.add_argument("--periodo")
    v.add_argument("--desde", type=int)
    v.add_argument("--hasta", type=int)
    _comunes(v)
    return ap


def _leidos(spark: SparkSession, args) -> DataFrame:
    """The files that ``cargar`` reads, also those without a row."""
    if args.exportaciones:
        patron = files.patron_exportaciones(args.origen, Period.parse(args.exportaciones), args.salida_nombre, args.ext)
        return files.archivos(spark, patron, files.EXPORT_RE)
    if args.carpetas:
        sal = files.escapar_glob(args.salida_nombre) if args.salida_nombre else "*"
        return files.archivos(spark, f"{args.origen.rstrip('/')}/salida={sal}/anio_mes=*/*.csv")
    return files.archivos(spark, files.patron_cargas(args.origen, args.salida_nombre))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = construir().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"workdays-{args.orden}").getOrCreate()

    if args.orden == "cargar":
        if args.exportaciones:
            crudo = files.leer_exportaciones(
                spark, args.origen, Period.parse(args.exportaciones), args.salida_nombre,
                args.ext, args.encoding, args.sep,
            )
        elif args.carpetas:
            sal = files.escapar_glob(args.salida_nombre) if args.salida_nombre else "*"
            crudo = files.leer_delimitado(
                spark, f"{args.origen.rstrip('/')}/salida={sal}/anio_mes=*/*.csv", sep=args.sep,
                encoding=args.encoding,
            )
        else:
            crudo = files.leer_cargas(spark, args.origen, args.salida_nombre, args.encoding, args.sep)
        r = ingest.ingerir(
            spark, args.destino, crudo, _leer(spark, args.programas), args.programa, args.cuarentena, leidos=_leidos(spark, args)
        )
        print(f"Insertados {r.insertadas} registros; en cuarentena {r.cuarentena}")
        return 0

    if args.orden == "reprocesar":
        r = ingest.reprocesar(spark, args.destino, args.cuarentena, _leer(spark, args.programas))
        print(f"Insertados {r.insertadas} registros; en cuarentena {r.cuarentena}")
        return 0

    if args.orden == "consolidar":
        crudo = files.leer_exportaciones(
            spark, args.origen, Period.parse(args.periodo), args.salida_nombre, args.ext, args.encoding, args.sep
        )
        patron = files.patron_exportaciones(args.origen, Period.parse(args.periodo), args.salida_nombre, args.ext)
        leidos = files.archivos(spark, patron, files.EXPORT_RE)
        mensual = files.carga_mensual(crudo)
        if args.carpetas:
            n = sinks.escribir_delimitado(mensual, args.destino, ("salida", "anio_mes"), args.sep, args.encoding, leidos)
        else:
            n = sinks.publicar(mensual, args.destino, tramos=leidos, sep=args.sep, encoding=args.encoding)
        print(f"Escritos {n} registros")
        return 0

    if args.orden == "informe":
        llamadas = spark.read.parquet(args.llamadas)
        kw = dict(
            period=_periodo(args.periodo),
            programa=args.programa,
            reglas=_leer(spark, args.reglas),
            excluir_marcadores=args.sin_marcadores,
        )
        if args.tipo == "todos":
            dims = [_leer(spark, getattr(args, t)) for t in ("agentes", "grupos", "programas")]
            if any(d is None for d in dims) or not args.salida:
                raise SystemExit("--agentes, --grupos, --programas and --salida are needed for 'todos'")
            trio = reports.informes_dias(llamadas, *dims, ordenar=True, **kw)
            base = args.salida.rstrip("/")
            for nombre, df in zip(("agente", "total", "grupo"), trio):
                if args.presentar and nombre != "agente":
                    df = presentar(df, titulos=args.titulos)
                args.salida = f"{base}/{nombre}"
                _escribir(df, args)
            return 0
        if args.tipo == "agente":
            df = reports.dias_por_agente(llamadas, **kw)
        else:
            dims = [_leer(spark, getattr(args, t)) for t in ("agentes", "grupos", "programas")]
            if any(d is None for d in dims):
                raise SystemExit("--agentes, --grupos and --programas are needed for this report")
            fn = reports.dias_con_total if args.tipo == "total" else reports.dias_por_grupo
            df = fn(llamadas, *dims, ordenar=True, **kw)
            if args.presentar:
                df = presentar(df, titulos=args.titulos)
        _escribir(df, args)
        return 0

    if args.orden == "media":
        df = reports.media_por_agente(
            spark.read.parquet(args.llamadas),
            period=_periodo(args.periodo),
            programa=args.programa,
            mensual=args.mensual,
            excluir_marcadores=args.sin_marcadores,
            ordenar=True,
        )
        _escribir(df, args)
        return 0

    if args.orden == "asistencia":
        df = attendance.asistencia_dia(
            spark,
            spark.read.parquet(args.agentes),
            spark.read.parquet(args.programas),
            args.fecha,
            args.programa,
            args.agente,
            calls=_leer(spark, args.llamadas),
        )
        if args.destino:
            from pyspark.sql import functions as F

            lote = df.withColumn("archivo", F.lit("asistencia")).withColumn(
                ingest.PARTICION, F.date_format("fecha", "yyyy-MM")
            )
            r = ingest.cargar(spark, args.destino, lote)
            print(f"Insertados {r.insertadas} registros")
        _escribir(df, args)
        return 0

    if args.orden == "cobertura":
        llamadas = spark.read.parquet(args.llamadas)
        df = coverage.cobertura(
            llamadas.select("programa_id", "fecha"),
            _leer(spark, args.programas),
            period=_periodo(args.periodo),
            d_ini=args.desde,
            d_fin=args.hasta,
        )
        _escribir(df, args)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
