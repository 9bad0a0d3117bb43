"""Fields of an extraction record, as its prompt asks for them. Values only, no logic.

Every entry must hold exactly these names for records, checks and reports to be
interchangeable with existing data.
"""

TEXT, NUMBER = "text", "number"
#: An object whose members depend on another field.
FREE = "free"

# -- fixed values: members of a record in order; a list stands for an array of such values --
TEMPLATE = {
    "文献元数据": {
        "标题": TEXT,
        "DOI": TEXT,
        "发表年份": NUMBER,
        "期刊": TEXT,
        "作者": [TEXT],
        "作者单位": [TEXT],
        "关键词": [TEXT],
    },
    "文献原文信息": {"摘要": TEXT, "结论": TEXT, "重要机理": TEXT},
    "基体信息": {"基体材料": TEXT, "预处理工艺": TEXT, "表面粗糙度Ra(μm)": NUMBER, "基体尺寸": TEXT},
    "粉末属性": [
        {
            "粉末编号": TEXT,
            "粉末名称/牌号": TEXT,
            "粉末制备方法": TEXT,
            "粒径分布": {"粒径范围(μm)": TEXT, "D10(μm)": NUMBER, "D50(μm)": NUMBER, "D90(μm)": NUMBER},
            "粉末形貌": TEXT,
            "松装密度(g/cm³)": NUMBER,
            "流动性(s/50g)": NUMBER,
            "增强相类型": TEXT,
            "润滑相类型": TEXT,
            "基体类型/种类": TEXT,
            "化学成分": [{"元素": TEXT, "质量分数(wt%)": NUMBER}],
        }
    ],
    "喷涂工艺参数": [{"样品/涂层编号": TEXT, "功能层类型": TEXT, "喷涂技术类型": TEXT, "工艺参数": FREE}],
    "微观组织结构": [
        {
            "样品/涂层编号": TEXT,
            "孔隙率(%)": NUMBER,
            "涂层厚度(μm)": NUMBER,
            "相组成": TEXT,
            "界面结合状态": TEXT,
            "组织结构": TEXT,
            "未熔颗粒含量(%)": NUMBER,
            "氧化物含量(%)": NUMBER,
            "裂纹密度": TEXT,
            "层状结构特征": TEXT,
            "涂层密度(g/cm³)": NUMBER,
        }
    ],
    "力学性能参数": [
        {
            "样品/涂层编号": TEXT,
            "显微硬度": {"类型": TEXT, "载荷(gf或N)": TEXT, "测试位置": TEXT, "平均值": NUMBER, "标准差": NUMBER},
            "结合强度(MPa)": {"测试标准": TEXT, "平均值": NUMBER, "断裂位置": TEXT},
            "弹性模量(GPa)": NUMBER,
            "断裂韧性(MPa·m½)": NUMBER,
            "残余应力": {"类型": TEXT, "数值(MPa)": NUMBER, "测试方法": TEXT},
        }
    ],
    "摩擦学性能": [
        {
            "样品/涂层编号": TEXT,
            "测试条件": {
                "对磨材料": TEXT, "载荷(N)": NUMBER, "滑动速度": TEXT, "温度(℃)": NUMBER, "润滑状态": TEXT, "测试设备": TEXT,
            },
            "摩擦系数": {"稳态平均值": NUMBER, "波动范围": TEXT},
            "磨损率": {"数值": NUMBER, "单位": TEXT},
            "磨损机理": TEXT,
            "磨损产物": TEXT,
        }
    ],
    "腐蚀性能": [
        {
            "样品/涂层编号": TEXT,
            "试验类型": TEXT,
            "腐蚀介质/环境": TEXT,
            "温度(℃)": NUMBER,
            "开路电位(V)": NUMBER,
            "腐蚀电流密度(A/cm²)": NUMBER,
            "点蚀电位(V)": NUMBER,
            "钝化膜电阻(Ω·cm²)": NUMBER,
            "腐蚀机理": TEXT,
            "腐蚀产物": TEXT,
            "拟合电路": TEXT,
            "备注": TEXT,
        }
    ],
    "涂层组分": [
        {
            "样品/涂层编号": TEXT,
            "组分类型": TEXT,
            "测试方法": TEXT,
            "组分详情": [{"组分名称": TEXT, "含量": TEXT, "单位": TEXT}],
            "备注": TEXT,
        }
    ],
    "热物理性能": [
        {
            "样品/涂层编号": TEXT,
            "热导率(W/mK)": {"测试温度(℃)": NUMBER, "数值": NUMBER},
            "热膨胀系数(10⁻⁶/K)": {"温度区间(℃)": TEXT, "数值": NUMBER},
            "抗热震性能": TEXT,
        }
    ],
    "耐久性试验": [{"样品/涂层编号": TEXT, "试验类型": TEXT, "试验参数": TEXT, "失效模式": TEXT, "寿命": TEXT}],
}

# -- fixed values: where samples are made, and the member that names one ----------------------
SPRAY_SECTION = "喷涂工艺参数"
SAMPLE_MEMBER = "样品/涂层编号"
POWDER_MEMBER = "粉末编号"
TECHNIQUE_MEMBER = "喷涂技术类型"
PARAMETERS_MEMBER = "工艺参数"

# -- fixed values: techniques; parameters that must be there, parameters that may be -----------
# Names joined by | are spellings of one parameter, by unit or by feedstock.
TECHNIQUES = {
    "APS": (
        ("电流(A)", "电压(V)", "功率(kW)", "主气流量(L/min)", "次气流量(L/min)", "喷涂距离(mm)", "送粉率(g/min)",
         "喷枪移动速度(mm/s)", "基体预热温度(℃)", "后处理工艺"),
        ("等离子气体类型及比例", "载气流量(L/min)", "步距(mm)", "冷却方式"),
    ),
    "HVOF": (
        ("氧气流量(L/min)", "燃料流量(L/min)|燃料流量(L/h)", "燃烧比", "喷涂距离(mm)", "送粉率(g/min)",
         "喷枪移动速度(mm/s)", "基体预热温度(℃)", "后处理工艺"),
        ("燃料类型", "燃烧室压力(bar)", "步距(mm)", "冷却方式"),
    ),
    "HVAF": (
        ("燃料类型", "空气流量(L/min)", "燃料流量(L/min)", "燃烧室压力(bar)", "喷涂距离(mm)", "送粉率(g/min)",
         "喷枪移动速度(mm/s)", "基体预热温度(℃)", "后处理工艺"),
        ("步距(mm)", "冷却方式"),
    ),
    "电弧喷涂": (
        ("电流(A)", "电压(V)", "气体压力(MPa)", "喷涂距离(mm)", "送丝速度(m/min)", "喷枪移动速度(mm/s)",
         "基体预热温度(℃)", "后处理工艺"),
        ("雾化气体类型", "步距(mm)", "冷却方式"),
    ),
    "冷喷涂": (
        ("工作气体类型及压力(MPa)", "气体预热温度(℃)", "喷涂距离(mm)", "送粉率(g/min)", "喷枪移动速度(mm/s)",
         "基体预热温度(℃)", "后处理工艺"),
        ("载气类型及流量", "步距(mm)", "粉末预热温度(℃)"),
    ),
    "火焰喷涂": (
        ("火焰类型", "燃气类型及压力", "氧气压力(MPa)", "送粉率(g/min)|送丝速度(m/min)", "喷涂距离(mm)",
         "喷枪移动速度(mm/s)", "基体预热温度(℃)", "后处理工艺"),
        ("步距(mm)",),
    ),
    "爆炸喷涂": (
        ("燃气类型", "氧气比例", "爆炸频率(Hz)", "喷涂距离(mm)", "送粉量(g/shot)", "喷枪移动速度(mm/s)",
         "基体预热温度(℃)", "后处理工艺"),
        ("充填气体类型", "步距(mm)"),
    ),
    "VPS/LPPS": (
        ("电流(A)", "电压(V)", "功率(kW)", "主气流量(L/min)", "喷涂距离(mm)", "送粉率(g/min)", "喷枪移动速度(mm/s)",
         "腔室压力(mbar)|腔室压力(Pa)", "基体预热温度(℃)", "后处理工艺"),
        ("等离子气体类型及比例", "次气流量", "载气流量", "步距(mm)"),
    ),
    "SPS/SPPS": (
        ("电流(A)", "电压(V)", "功率(kW)", "喷涂距离(mm)", "液体送料速率(mL/min)", "喷枪移动速度(mm/s)",
         "基体预热温度(℃)", "后处理工艺"),
        ("等离子气体类型", "载气流量", "液滴雾化参数", "步距(mm)"),
    ),
    "PS-PVD": (
        ("电流(A)", "电压(V)", "功率(kW)", "喷涂距离(mm)", "送粉率(g/min)", "腔室压力(Pa)", "喷枪移动速度(mm/s)",
         "基体预热温度(℃)", "后处理工艺"),
        ("等离子气体类型及比例", "载气流量", "步距(mm)"),
    ),
}
