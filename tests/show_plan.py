"""Print the operator skeleton of a registered query's executed plan.

Usage: python tests/show_plan.py QUERY [SF_DIR]
Runs the query once (so adaptive execution settles), then prints every
exchange, join, aggregate, window and generator of the final plan.
"""

import re
import sys

sys.path.insert(0, "/root/repo")

KEEP = re.compile(r"(\*\(\d+\) )?(\w*Exchange|Reused|\w*Join|\w*Aggregate|Window|Generate|\w*Scan|Scan|Sort \[|Union|TakeOrdered|"
                  r"\w*Python|\w*InArrow)")


def main():
    from pagelens.session import get_spark
    import __spark_entry__ as E
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    df = E.queries()[name](spark, sf)
    df.collect()  # executes this DataFrame's own plan, so the final plan is printed
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for line in plan.splitlines():
        body = line.lstrip(" :+-")
        if KEEP.match(body):
            depth = (len(line) - len(body)) // 3
            print(f"{depth:3d} " + re.sub(r"\[.{100,}", "[...]", body)[:140])


if __name__ == "__main__":
    main()
