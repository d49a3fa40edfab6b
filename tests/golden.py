"""The golden case: readings, template and expected verdicts."""

DAY = "2021-04-23 "

RAW = """2,E1,M 1#1,08:00:00,3,4,0,3
1,E1,M 1#1,08:00:01,0,0,0,0
2,E1,M 1#1,08:00:01,3,4,0,3
3,E1,M 1#1,08:00:01,6,8,0,6
1,E1,M 1#1,08:00:02,0,0,0,0
2,E1,M 1#1,08:00:02,3,4,0,3
3,E1,M 1#1,08:00:03,6,9,0,6
1,E1,M 1#1,08:00:04,0,0,0,0
2,E1,M 1#1,08:00:04,3,4,0,3
1,E1,M 1#1,08:00:05,0,0,0,0
2,E1,M 1#1,08:00:05,3,4,0,3
3,E1,M 1#1,08:00:05,6,8,0,6
4,E1,M 1#1,08:00:05,9,12,0,9
1,E1,M 1#1,08:00:06,0,0,0,0
2,E1,M 1#1,08:00:06,3,4,0,3
2,E1,M 1#1,08:00:06,6,8,0,6
1,E1,M 1#1,08:00:07,0,0,0,0
2,E1,M 1#1,08:00:07,3,4,0,3
2,E1,M 1#1,08:00:07,3,4,0,3
3,E1,M 1#1,08:00:07,6,8,0,6
1,E1,M 1#1,08:00:08,0,0,0,0
2,E1,M 1#1,08:00:08,3,4,0,3
3,E1,M 1#1,08:00:08,abc,8,0,6
1,E1,M 1#1,08:00:09,0,0,0,0
2,E1,M 1#1,08:00:09,5.5,0,0,3
3,E1,M 1#1,08:00:09,5.5,5,0,6
1,E1,M 1#1,08:00:10,0,0,0,0
2,E1,M 1#1,08:00:10,3,4,0,3
3,E1,M 1#1,08:00:10,NaN,8,0,6
1,E1,M 2#1,08:00:11,0,0,0,0
2,E1,M 2#1,08:00:11,3,4,0,3
3,E1,M 2#1,08:00:11,6,8,0,6
1,E1,M 1#1,08:00:12,0,0,0,0
2,E1,M 1#1,08:00:12,3,4,0,3
3,E1,M 1#1,08:00:12,6,9,3,9
0,E1,M 1#1,08:00:12,1,1,1,1
2,E2,M1,08:00:00,0,0,0,0
3,E2,M1,08:00:00,3,4,0,3
4,E2,M1,08:00:00,6,9,0,6
1,E2,M1,08:00:01,0,0,0,0
3,E2,M1,08:00:01,6,8,0,6
5,E2,M1,08:00:01,9,12,0,9"""

READINGS = []
for text in RAW.splitlines():
    line, eq, mc, time, *coordinates = text.split(",")
    READINGS.append((int(line), eq, mc, DAY + time, *coordinates))

# lineNmb, leadDiff, padDiff, leadThreshold, padThreshold
TEMPLATE = [(1, 0.0, 0.0, 0.5, 0.5), (2, 5.0, 3.0, 0.5, 0.5), (3, 5.0, 3.0, 0.5, 0.5)]

VERDICTS = [
    ("E1", "M 1#1", None, 2, "少线: 【实际/标准: 1/3】"),
    ("E1", "M 1#1", DAY + "08:00:01", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:02", 1, "lineNmb3_leadOffset_0.83_padOffset_0.00"),
    ("E1", "M 1#1", DAY + "08:00:04", 2, "少线: 【实际/标准: 2/3】"),
    ("E1", "M 1#1", DAY + "08:00:06", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:07", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:08", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:09", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:10", 0, "qualified"),
    ("E1", "M 1#1", DAY + "08:00:12", 1, "lineNmb3_leadOffset_0.83_padOffset_3.71"),
    ("E2", "M1", None, 1, "lineNmb4_leadOffset_0.83_padOffset_0.00"),
    ("E2", "M1", DAY + "08:00:01", 1, "lineNmb3_leadOffset_5.00_padOffset_3.00"),
]
