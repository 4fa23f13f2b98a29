import pytest

from payguard.config import KafkaSecurity, RunSettings


def test_blank_args_take_defaults():
    s = RunSettings.from_args(raw_topic="", risk_topic=None, group_id="g1")
    assert (s.raw_topic, s.risk_topic, s.group_id) == ("procure-raw", "procure-risk", "g1")
    assert not s.uses_model and RunSettings.from_args(model_predictor_url="http://m").uses_model


def test_security_protocols(tmp_path):
    pw = tmp_path / "pw"
    pw.write_text("secret\nignored\n")
    assert KafkaSecurity().options().get("kafka.security.protocol") is None
    scram = KafkaSecurity(scram_username="u", scram_password_path=str(pw)).options()
    assert scram["kafka.security.protocol"] == "SASL_PLAINTEXT" and 'password="secret"' in scram["kafka.sasl.jaas.config"]
    tls = KafkaSecurity(truststore_path="/ts.p12", truststore_password_path=str(pw)).options()
    assert tls["kafka.security.protocol"] == "SSL" and tls["kafka.ssl.truststore.type"] == "PKCS12"
    both = KafkaSecurity(scram_username="u", scram_password_path=str(pw), truststore_path="/ts",
                         truststore_password_path=str(pw)).options()
    assert both["kafka.security.protocol"] == "SASL_SSL"


def test_incomplete_security_fails_fast():
    with pytest.raises(ValueError):
        KafkaSecurity(scram_username="u").options()
    with pytest.raises(ValueError):
        KafkaSecurity(tls_version="TLSv1.2").options()


def test_from_argv():
    s = RunSettings.from_argv(["--groupId", "g2", "--rawTopic", "", "--modelPredictorURL", "http://m/p",
                               "--unknown", "x"])
    assert (s.group_id, s.raw_topic, s.model_predictor_url) == ("g2", "procure-raw", "http://m/p")
    assert s.uses_model
