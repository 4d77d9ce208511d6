"""Training-data operators: licences, secrets, quality, decontamination, line and near-duplicate removal, URL filters, HTML text, tokens."""
