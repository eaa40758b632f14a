SMALL = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((row.asDict() for row in frame.collect()), key=str)
