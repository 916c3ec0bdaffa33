"""spark-submit entry point: ``spark-submit --py-files dqspark.zip run_quality.py --tables … --out …``."""

from dqspark.__main__ import main

if __name__ == "__main__":
    main()
