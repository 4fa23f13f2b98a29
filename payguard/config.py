"""Run settings (job arguments, sink batching, security options).

A blank argument falls back to its default, as the job arguments do. The
choice between rule and model grading is made once, when the plan is built:
a blank ``model_predictor_url`` means the rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# Risk labels, default model name, thresholds.
RISK_LOW = "Low"
RISK_MEDIUM = "Medium"
RISK_HIGH = "High"
PAY_TYPE_LATE = "Late"
DEFAULT_MODEL_NAME = "anomaly-classifier-predictor"
RULE_AMOUNT_LIMIT = 5000.0      # amount <= limit -> Low
RULE_DELAY_LIMIT = 90           # else delay <= limit -> Medium, else High
MODEL_MEDIUM_ABOVE = 50         # model output > 50 -> Medium
MODEL_HIGH_ABOVE = 100          # model output > 100 -> High
RETENTION_MS = 604_800_000      # 7 days
# Event envelope constants.
SPEC_VERSION = "1.0"
JSON_CONTENT_TYPE = "application/json"
FORWARD_EVENT_TYPE = "dev.knative.kafka.event"


def _blank(v: str | None) -> bool:
    return v is None or v == ""


@dataclass(frozen=True)
class RunSettings:
    """Job arguments. Blank values take the default."""

    group_id: str = "risk-processor"
    raw_topic: str = "procure-raw"
    risk_topic: str = "procure-risk"
    raw_table: str = "procure_raw"
    risk_table: str = "procure_risk"
    model_predictor_url: str = ""
    model_ca_file: str = ""         # CA bundle for an https model server
    model_name: str = DEFAULT_MODEL_NAME
    # Envelope attributes of what we publish. They are settings, not logic.
    event_source: str = "urn:payguard:producer"
    raw_event_type: str = "procure.events.sample"
    risk_event_type: str = "procure.risk"
    # The stream job starts a micro-batch, which flushes every sink, this often. Of
    # one request to a search index (``sources.bulk``) these are the greatest age, documents and bytes.
    bulk_interval_ms: int = 3000
    bulk_rows: int = 3000
    bulk_bytes: int = 50 * 1024 * 1024
    # Index tables: days that are kept (None: all).
    retention_days: int | None = None
    # How far behind the newest record a record that is delivered again is still known ("7 days"); None: not asked.
    dedupe_within: str | None = None
    # Bound of a micro-batch. A fresh checkpoint reads the topic from its first
    # record, and the fan-out stores a batch's late invoices and errors while it
    # writes the sinks: they stay bounded, however long the topic is. What is stored doesn't depend on where batches end.
    max_records_per_trigger: int = 20_000_000
    max_files_per_trigger: int = 1000

    @classmethod
    def from_args(cls, **kwargs: str | None) -> "RunSettings":
        base = cls()
        clean = {k: v for k, v in kwargs.items() if not _blank(v)}
        return cls(**{**base.__dict__, **clean})

    # Job argument names (``--name value``) -> fields.
    ARG_NAMES = {"groupId": "group_id", "rawTopic": "raw_topic", "riskTopic": "risk_topic",
                 "esRawIndex": "raw_table", "esRiskIndex": "risk_table",
                 "modelPredictorURL": "model_predictor_url", "modelName": "model_name", "modelCaFile": "model_ca_file",
                 "dedupeWithin": "dedupe_within"}

    @classmethod
    def from_argv(cls, argv: list[str]) -> "RunSettings":
        """Parse ``--name value`` job arguments; unknown names are ignored and
        a blank value keeps the default."""
        vals: dict[str, str] = {}
        i = 0
        while i < len(argv):
            a = argv[i]
            if a.startswith("-"):
                name = a.lstrip("-")
                value = argv[i + 1] if i + 1 < len(argv) and not argv[i + 1].startswith("--") else ""
                if name in cls.ARG_NAMES:
                    vals[cls.ARG_NAMES[name]] = value
                i += 2 if value else 1
            else:
                i += 1
        return cls.from_args(**vals)

    @property
    def uses_model(self) -> bool:
        return not _blank(self.model_predictor_url)

    def ca_data(self) -> str | None:
        """The PEM text of the model server's authorities, read on the driver."""
        if _blank(self.model_ca_file):
            return None
        with open(self.model_ca_file, encoding="ascii") as f:
            return f.read()

    @property
    def trigger_interval(self) -> str:
        return f"{self.bulk_interval_ms} milliseconds"


@dataclass(frozen=True)
class KafkaSecurity:
    """SCRAM and/or TLS settings, turned into ``kafka.*`` source/sink options.

    SCRAM only -> SASL_PLAINTEXT, TLS only -> SSL, both -> SASL_SSL.
    Passwords come from the first line of a file.
    """

    bootstrap_servers: str = "localhost:9092"
    scram_username: str | None = None
    scram_password_path: str | None = None
    truststore_path: str | None = None
    truststore_password_path: str | None = None
    truststore_type: str = "PKCS12"
    tls_version: str | None = None
    extra: dict = field(default_factory=dict)

    @staticmethod
    def _first_line(path: str) -> str:
        with open(path, encoding="utf-8") as fh:
            return fh.readline().rstrip("\r\n")

    def options(self) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.bootstrap_servers}
        scram = not _blank(self.scram_username) or not _blank(self.scram_password_path)
        if scram and (_blank(self.scram_username) or _blank(self.scram_password_path)):
            raise ValueError("SCRAM needs both a user name and a password file")
        tls = self.tls_version is not None or not _blank(self.truststore_path)
        if tls and (_blank(self.truststore_path) or _blank(self.truststore_password_path)):
            raise ValueError("TLS needs a truststore and its password file")
        if scram:
            pw = self._first_line(self.scram_password_path)
            opts["kafka.sasl.mechanism"] = "SCRAM-SHA-512"
            opts["kafka.sasl.jaas.config"] = (
                "org.apache.kafka.common.security.scram.ScramLoginModule required "
                f'username="{self.scram_username}" password="{pw}";'
            )
            opts["kafka.security.protocol"] = "SASL_PLAINTEXT"
        if tls:
            opts["kafka.ssl.truststore.location"] = self.truststore_path
            opts["kafka.ssl.truststore.password"] = self._first_line(self.truststore_password_path)
            opts["kafka.ssl.truststore.type"] = self.truststore_type
            opts["kafka.security.protocol"] = "SSL"
        if scram and tls:
            opts["kafka.security.protocol"] = "SASL_SSL"
        opts.update(self.extra)
        return opts
