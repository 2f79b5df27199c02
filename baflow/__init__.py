"""baflow: allele-signal segmentation and copy-number calling as Spark DataFrame jobs.

Every stage is a DataFrame operator keyed by ``sample_id`` and ``chrom``; see README.md.
"""

__version__ = "0.1.0"
