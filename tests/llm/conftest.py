import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"
