"""Operations of a training-data pipeline: coding, extraction, mixing, fingerprints, chat, quality, licences, scoring, joins."""
