"""Reading delimited files, sniffing encodings, generating vectors, exporting splits."""
