"""Training-data operators: sharding, de-duplication, secret and license scans, benchmark
decontamination, WARC, quality rules and BPE. Nothing outside this folder imports it."""
