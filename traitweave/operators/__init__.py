"""Phenotype specs, what they see of a participant row, joins on the participant id, label arrays."""
