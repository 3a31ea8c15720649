import datetime as dt

FLAT_DDL = ("numero_processo string, sigla_tribunal string, grau string, data_ajuizamento timestamp, "
            "codigo_classe bigint, nome_classe string, codigo_orgao bigint, nome_orgao string, "
            "nivel_sigilo bigint, codigo_movimento bigint, nome_movimento string, data_movimento timestamp")


def ev(case, code, ts, filed="2020-01-01", court="TJRS", cls=(1, "Classe"), org=(10, "Vara"),
       name=None, grau="G1"):
    t = None if ts is None else dt.datetime.fromisoformat(ts)
    return (case, court, grau, dt.datetime.fromisoformat(filed), cls[0], cls[1], org[0], org[1], 0,
            code, name or f"mov {code}", t)


def flat(spark, events, ingest=None):
    df = spark.createDataFrame(events, FLAT_DDL)
    if ingest:
        from pyspark.sql import functions as F
        df = df.withColumn("data_ingestao", F.to_timestamp(F.lit(ingest)))
    return df
