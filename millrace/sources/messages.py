"""Message topics: Kafka and Event Hubs through the Kafka protocol.

The reader needs the public Spark Kafka connector on the class path. Everything after it takes any
DataFrame with ``value`` and ``timestamp``, batch or stream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Secrets = Callable[[str, str], str]

# Spec entries and connection formats of the two message services.
KAFKA_SERVERS = "kafka.bootstrap.servers"
KAFKA_SOURCE_SECRET = ("kafka_source_servers_secrets_scope_name", "kafka_source_servers_secrets_scope_key")
KAFKA_SINK_SECRET = ("kafka_sink_servers_secret_scope_name", "kafka_sink_servers_secret_scope_key")
TRUSTSTORE_LOCATION = "kafka.ssl.truststore.location"
KEYSTORE_LOCATION = "kafka.ssl.keystore.location"
TRUSTSTORE_SECRET = ("kafka.ssl.truststore.secrets.scope", "kafka.ssl.truststore.secrets.key")
KEYSTORE_SECRET = ("kafka.ssl.keystore.secrets.scope", "kafka.ssl.keystore.secrets.key")
EVENTHUB_HOST = "{namespace}.servicebus.windows.net"
EVENTHUB_JAAS = (
    "org.apache.kafka.common.security.plain.PlainLoginModule required "
    'username="$ConnectionString" password="Endpoint=sb://{host}/;'
    'SharedAccessKeyName={key_name};SharedAccessKey={key}";'
)


class MessageConfigError(ValueError):
    """A message source or sink lacks an entry."""


def _secret(secrets: Secrets | None, scope: str, key: str) -> str:
    if secrets is None:
        raise MessageConfigError(f"secret {scope}/{key} is needed but no secrets function was given")
    return secrets(scope, key)


def _ssl_options(details: Mapping[str, str], secrets: Secrets | None) -> dict[str, str]:
    """Key and trust store with their passwords; all four secret entries or none."""
    if not (details.get(TRUSTSTORE_LOCATION) and details.get(KEYSTORE_LOCATION)):
        return {}
    needed = [*TRUSTSTORE_SECRET, *KEYSTORE_SECRET]
    absent = [n for n in needed if not details.get(n)]
    if absent:
        raise MessageConfigError(f"SSL needs the entries {needed}; missing are {absent}")
    return {
        TRUSTSTORE_LOCATION: details[TRUSTSTORE_LOCATION],
        KEYSTORE_LOCATION: details[KEYSTORE_LOCATION],
        "kafka.ssl.truststore.password": _secret(secrets, *(details[n] for n in TRUSTSTORE_SECRET)),
        "kafka.ssl.keystore.password": _secret(secrets, *(details[n] for n in KEYSTORE_SECRET)),
    }


def kafka_options(
    details: Mapping[str, str], options: Mapping[str, str] | None = None, secrets: Secrets | None = None
) -> dict[str, str]:
    """Reader options of a topic; the user's own win."""
    servers = details.get(KAFKA_SERVERS)
    if not servers:
        scope, key = (details.get(n) for n in KAFKA_SOURCE_SECRET)
        if not (scope and key):
            raise MessageConfigError(f"no broker: give {KAFKA_SERVERS} or {KAFKA_SOURCE_SECRET}")
        servers = _secret(secrets, scope, key)
    topic = details.get("subscribe")
    if not topic:
        raise MessageConfigError("no topic: give subscribe")
    return {
        KAFKA_SERVERS: servers,
        "subscribe": topic,
        **_ssl_options(details, secrets),
        **(options or {}),
    }


def _eventhub_connection(details: Mapping[str, str], secrets: Secrets | None) -> dict[str, str]:
    wanted = ["eventhub.namespace", "eventhub.port", "eventhub.name", "eventhub.accessKeyName"]
    absent = [n for n in wanted if not details.get(n)]
    if absent:
        raise MessageConfigError(f"event hub entries {absent} are missing")
    host = EVENTHUB_HOST.format(namespace=details["eventhub.namespace"])
    key_name = details["eventhub.accessKeyName"]
    # the secret goes by the key's name unless it has its own
    secret_name = details.get("eventhub.accessKeySecretName") or key_name
    key = _secret(secrets, details.get("eventhub.secretsScopeName"), secret_name)
    return {
        KAFKA_SERVERS: f"{host}:{details['eventhub.port']}",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": EVENTHUB_JAAS.format(host=host, key_name=key_name, key=key),
    }


def eventhub_options(
    details: Mapping[str, str], options: Mapping[str, str] | None = None, secrets: Secrets | None = None
) -> dict[str, str]:
    """Reader options of an event hub; the user's own win."""
    connection = _eventhub_connection(details, secrets)
    return {**connection, "subscribe": details["eventhub.name"], **(options or {})}


def message_sink_options(
    sink_format: str, options: Mapping[str, str], secrets: Secrets | None = None
) -> dict[str, str]:
    """Kafka writer options of a message sink, with secrets looked up and their entries removed."""
    if sink_format == "eventhub":
        rest = {k: v for k, v in options.items() if not k.startswith("eventhub.")}
        return {**rest, **_eventhub_connection(options, secrets), "topic": options["eventhub.name"]}
    used = {*KAFKA_SINK_SECRET, *TRUSTSTORE_SECRET, *KEYSTORE_SECRET}
    rest = {k: v for k, v in options.items() if k not in used}
    scope, key = (options.get(n) for n in KAFKA_SINK_SECRET)
    if scope and key:
        rest[KAFKA_SERVERS] = _secret(secrets, scope, key)
    if not rest.get(KAFKA_SERVERS):
        raise MessageConfigError(f"no broker: give {KAFKA_SERVERS} or {KAFKA_SINK_SECRET}")
    return {**rest, **_ssl_options(options, secrets)}


def message_scan(spark: SparkSession, options: Mapping[str, str], schema=None, streaming: bool = True) -> DataFrame:
    """A topic with its time columns and, given a schema, the parsed payload."""
    reader = spark.readStream if streaming else spark.read
    return message_frame(reader.format("kafka").options(**options).load(), schema)


def message_frame(raw: DataFrame, schema=None) -> DataFrame:
    """Add ``date``, ``hour``, ``minute`` and, given a schema, ``parsed_records``.

    A malformed payload parses to a struct of NULLs; only a NULL payload gives NULL.
    """
    df = raw.withColumns(
        {"date": F.to_date("timestamp"), "hour": F.hour("timestamp"), "minute": F.minute("timestamp")}
    )
    if schema is None:
        return df
    return df.withColumn("parsed_records", F.from_json(F.col("value").cast("string"), schema))


def message_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as messages: JSON text in ``value``, and a key column if one is named."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)
